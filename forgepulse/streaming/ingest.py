"""The continuous form of loading landed hours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from forgepulse.clock import AsOf
from forgepulse.operators.ingestion import files_of_hours, load_files
from forgepulse.sources.landing import stream_landed
from forgepulse.sources.storage import Scratch
from forgepulse.sources.warehouse import Warehouse, landed_files, landed_hours


def load_available(
    warehouse: Warehouse, folder: str, as_of: AsOf, checkpoint: str,
    max_files: int | None = None, only_report_nulls: bool = False,
) -> StreamingQuery:
    """Loads all landed files not seen before into the warehouse, then stops.

    Each micro-batch is a load of its files like any other: ids already stored are
    recognised, unusable records are kept by file, and an hour is `loaded` once all files
    landed for it are. So events, quarantine and ledger are the same however files fall into
    batches and however late an event is. A batch repeated after a failure changes nothing,
    and one that fails its audit publishes nothing, however often it is tried. A file
    without a single record gives no row; its hour is `partial` until a load of whole hours
    takes it in. `max_files` bounds a batch.
    """
    spark = warehouse.spark

    def load_batch(batch: DataFrame, _: int) -> None:
        with Scratch(spark, warehouse.path("_scratch")) as scratch:
            landed = scratch.keep(batch.drop("created"))
            files = [
                (row.file, row.source_file)
                for row in landed.select("file", "source_file").distinct().collect()
            ]
            paths = landed_hours(spark, folder)
            hours = {hour: paths[hour] for _, hour in files}
            counts = files_of_hours(landed_files(spark, hours))
            load_files(warehouse, landed, files, counts, as_of, scratch, only_report_nulls)

    landed = stream_landed(spark, folder, max_files)
    return (
        landed.writeStream.foreachBatch(load_batch).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def write_available(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends all that is available to a parquet folder, then stops."""
    return (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
