"""Every report read in its order against the same order in DuckDB."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from forgepulse.plans.layers import READ_ORDER, read_model, write_model
from forgepulse.sources.warehouse import Warehouse

# Large enough that every report has rows.
DATA = "/root/testdata/sf0.01"


@pytest.mark.parametrize("model", list(READ_ORDER))
def test_reading_order_equals_sql(spark, tmp_path, model):
    """All descending, nulls last; rows that tie may stand in any order among themselves."""
    duck = duckdb.connect()
    for path in Path(DATA).glob("*.parquet"):
        duck.execute(f"create view {path.stem} as select * from '{path}'")
    columns = READ_ORDER[model][1:]
    order = ", ".join(f"{name} desc nulls last" for name in columns)
    wanted = duck.execute(f"select {', '.join(columns)} from ({registry.oracle_sql()[model]}) order by {order}").fetchall()
    warehouse = Warehouse(spark, str(tmp_path))
    write_model(warehouse, model, registry.own_queries()[model](spark, DATA))
    read = read_model(warehouse, model, ordered=True)
    assert [tuple(row[name] for name in columns) for row in read.collect()] == wanted
    best = read_model(warehouse, model, top=7)
    assert [tuple(row[name] for name in columns) for row in best.collect()] == wanted[:7]
    for rows in (read, best):
        assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString().replace("SinglePartition", "")
    assert len(wanted) > 1


def test_nulls_come_last(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    rows = [(1, None), (2, 0.5), (3, 30.0), (4, None), (5, -1.0)]
    write_model(warehouse, "mart_viral_velocity", spark.createDataFrame(rows, "repo_id bigint, velocity_ratio double"))
    read = read_model(warehouse, "mart_viral_velocity", ordered=True)
    assert [row.velocity_ratio for row in read.collect()] == [30.0, 0.5, -1.0, None, None]


def test_the_first_rows_are_read_from_few_chunks(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(5000).select(
            F.col("id").alias("repo_id"), F.when(F.col("id") % 10 > 0, F.col("id") * 0.5).alias("velocity_ratio")
        )
        write_model(warehouse, "mart_viral_velocity", rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    entry = warehouse.version().get("marts/mart_viral_velocity")
    assert len(entry["rows"]) >= 3 and sum(entry["rows"].values()) == 5000
    wanted = sorted((0.5 * i for i in range(5000) if i % 10), reverse=True) + [None] * 500
    assert [row[1] for row in read_model(warehouse, "mart_viral_velocity", ordered=True).collect()] == wanted
    best = read_model(warehouse, "mart_viral_velocity", top=20)
    assert [row[1] for row in best.collect()] == wanted[:20]
    assert len(best.inputFiles()) == 1 < len(read_model(warehouse, "mart_viral_velocity").inputFiles())
    most = read_model(warehouse, "mart_viral_velocity", top=4700)
    assert [row[1] for row in most.collect()] == wanted[:4700]
    assert read_model(warehouse, "mart_viral_velocity", top=0).isEmpty()


def test_an_empty_report_has_an_order_too(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    write_model(warehouse, "mart_viral_velocity", spark.createDataFrame([], "repo_id bigint, velocity_ratio double"))
    assert read_model(warehouse, "mart_viral_velocity", ordered=True).isEmpty()
    assert read_model(warehouse, "mart_viral_velocity").columns == ["repo_id", "velocity_ratio"]
