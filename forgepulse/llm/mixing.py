"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forgepulse.llm.common import positions, same, word_count
from forgepulse.sources.storage import Scratch

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CEILING = 2.0
SEED = 42


def source_targets(
    sized: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
    ceiling: float = CEILING,
) -> DataFrame:
    """A row per source: its size and its target.

    Sources by code point, null last, get the weights in turn. Together they get `share`
    of all sizes, in proportion to the weights; none gets over `ceiling` times its own
    size, and what such sources leave goes to the others by weight. The fixed point is a
    common level per unit of weight: sorted by the level at which a source is full, the
    first source that the remaining amount doesn't fill gives the level. The windows
    hold a row per source, never documents.
    """
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    by_need = Window.orderBy(F.col("full_at"), F.asc_nulls_last("source"))
    everywhere = Window.partitionBy()
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    cycle = F.array(*[F.lit(weight) for weight in weights])
    weighed = sources.withColumn(
        "weight", F.get(cycle, F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))))
    ).withColumn("cap", F.lit(ceiling) * F.col("source_size")).withColumn(
        "full_at", F.col("cap") / F.col("weight")
    )
    full = F.coalesce(
        F.sum("cap").over(by_need.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)
    )
    left = F.sum("weight").over(by_need.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(everywhere)
    levelled = weighed.withColumn("level", (F.lit(share) * total - full) / left)
    fits = F.col("level") * F.col("weight") <= F.col("cap")
    level = F.first(F.when(fits, F.col("level")), ignorenulls=True).over(
        by_need.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    return levelled.withColumn("common", level).select(
        "source", "source_size",
        F.least("cap", F.coalesce(F.col("common") * F.col("weight"), F.col("cap"))).alias("target"),
    )


def offset(source: Column, seed: int = SEED) -> Column:
    """The source's one random number in [0, 1), the same in every run."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(source, F.lit(""))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def mix(
    docs: DataFrame, scratch: Scratch, size: Column | None = None,
    weights: Sequence[int] = WEIGHTS, share: float = SHARE, ceiling: float = CEILING,
    seed: int = SEED,
) -> DataFrame:
    """All rows of `docs` with `size`, `source_size`, `target` and `copies` (0 to ceiling).

    Every document of a source expects target / source size copies. The expectations are
    added up along the source, one random offset is added, and a document is taken once
    for each whole number its own interval passes. Documents lie in order of size, so
    the taken words of a source differ from its target by no more than its largest
    document: each step of the sum picks from documents of almost equal size.

    Null or empty texts have size 0; they cross boundaries like others but take no words.
    A source of size 0 has target 0 and takes nothing. A null source is a source of its
    own. Repeated rows are separate rows. Columns named as the results are replaced.
    """
    scratch = scratch.inner()
    size = word_count(F.col("text")) if size is None else size
    sized = docs.drop("source_size", "target", "copies").withColumn("size", size)
    placed = positions(sized, ["source"], ["size", "doc_id"], scratch, "mix", "__place")
    targets = scratch.keep(source_targets(
        placed.select("source", "size"), weights, share, ceiling
    ), name="mix-targets")
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(
        F.lit(0.0)
    )
    start = F.col("__place") * F.col("__expected") + F.col("__offset")
    end = (F.col("__place") + 1) * F.col("__expected") + F.col("__offset")
    kept = [name for name in sized.columns if name not in ("source_size", "target", "copies")]
    return (
        placed.join(targets, same(placed, targets, ["source"]))
        .select(
            *[placed[name] for name in kept], placed["__place"], targets["source_size"],
            targets["target"], expected.alias("__expected"),
            offset(placed["source"], seed).alias("__offset"),
        )
        .select(
            *kept, "source_size", "target", (F.floor(end) - F.floor(start)).alias("copies")
        )
    )


def repeated(mixed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The mix itself: each row of `mix` as often as it is taken."""
    times = F.array_repeat(F.lit(True), F.col("copies").cast("int"))
    return mixed.where("copies > 0").withColumn("_copy", F.explode(times)).select(*columns)


ORACLE = rf"""
with sized as (
  select doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size
  from documents
), sources as (
  select source, sum(size)::bigint as source_size,
    list_extract({list(WEIGHTS)}, cast((row_number() over (order by source nulls last) - 1)
      % {len(WEIGHTS)} as int) + 1) as weight
  from sized group by source
), caps as (
  select *, {CEILING}::double * source_size as cap, {CEILING}::double * source_size / weight as full_at,
    sum(source_size) over () as total
  from sources
), levels as (
  select *, ({SHARE}::double * total
      - coalesce(sum(cap) over (need rows between unbounded preceding and 1 preceding), 0))
    / sum(weight) over (need rows between current row and unbounded following) as level,
    row_number() over need as place
  from caps window need as (order by full_at, source nulls last)
), common as (
  select min_by(level, place) as common from levels where level * weight <= cap
), targets as (
  select source, source_size, least(cap, coalesce(common * weight, cap)) as target,
    ('0x' || substr(md5('{SEED}|' || coalesce(source, '')), 1, 8))::bigint / {2**32}::double as start
  from levels, common
), placed as (
  select d.doc_id, d.source, d.size, t.source_size, t.target, t.start,
    case when t.source_size > 0 then t.target / t.source_size else 0.0::double end as expected,
    row_number() over (partition by d.source order by d.size, d.doc_id) - 1 as position
  from sized d join targets t on d.source is not distinct from t.source
), taken as (
  select *, (floor((position + 1) * expected + start) - floor(position * expected + start))::bigint
    as copies
  from placed
)
select doc_id, size, source_size, target, copies * size as taken, source, copies from taken
"""
