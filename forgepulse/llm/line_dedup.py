"""Line dedup: keep bitmaps from range-partitioned line hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forgepulse.llm.common import ascii_lower, known_id
from forgepulse.sources.storage import Scratch

MIN_CHARS = 10
# A line with more than this part of all lines, and more rows than a task sorts with ease,
# is taken out before the sort.
HOT_PART = 4096
HOT_ROWS = 4096
BUCKETS = 1 << 16
WHITE = " \t\n\x0b\f\r"


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(WHITE)))


def _version(text: Column) -> Column:
    """Tells rows with the same doc_id but other texts apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def line_hashes(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """A row per line long enough: its document, its place, and 128 bits of its key's hash."""
    key = line_key(F.col("line"))
    return (
        docs.select(
            known_id(F.col("doc_id")).alias("did"), _version(F.col("text")).alias("version"),
            F.posexplode(split_lines(F.col("text"))).alias("pos", "line"),
        )
        .select("did", "version", "pos", key.alias("key"))
        .where(F.length("key") >= min_chars)
        .select(
            "did", "version", "pos", F.xxhash64("key").alias("h1"),
            F.xxhash64(F.lit(1), F.col("key")).alias("h2"),
        )
    )


def _hot_lines(lines: DataFrame, scratch: Scratch) -> DataFrame:
    """The lines with over HOT_ROWS rows and over 1 / HOT_PART of all rows, so HOT_PART lines at
    most, and the first document of each. A count by hash bucket finds where they can be; only those buckets
    are counted by line."""
    sizes = scratch.keep(
        lines.groupBy(F.pmod("h1", F.lit(BUCKETS)).alias("bucket")).agg(F.count("*").alias("n")),
        name="bucket-sizes",
    )
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = (F.col("n") > HOT_ROWS) & (F.col("n") * HOT_PART > total)
    large = sizes.where(hot).select("bucket")
    return (
        # At most HOT_PART buckets hold over 1 / HOT_PART of the rows each.
        lines.withColumn("bucket", F.pmod("h1", F.lit(BUCKETS)))
        .join(F.broadcast(large), "bucket", "left_semi")
        .groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("did").alias("first_did"))
        .where(hot)
        .select("h1", "h2", "first_did")
    )


def repeated_lines(lines: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows of lines that an earlier document holds.

    Rows are range-partitioned by hash and sorted within by document and position, so a
    running window, which needs no further shuffle, streams each line's first document
    past its later ones. The few lines that make up a large part of many rows never enter
    a range: their first document comes from an aggregate that combines before it
    shuffles, and is broadcast (HOT_PART rows at most).
    """
    hot = scratch.keep(_hot_lines(lines, scratch), name="hot-lines")
    key = ["h1", "h2"]
    ranged = lines.join(F.broadcast(hot), key, "left_anti").repartitionByRange(*key)
    in_order = Window.partitionBy(*key).orderBy("did", "version", "pos").rowsBetween(
        Window.unboundedPreceding, 0
    )
    rest = ranged.withColumn("first_did", F.first("did").over(in_order))
    often = lines.join(F.broadcast(hot), key)
    columns = ["did", "version", "pos", "first_did"]
    return rest.select(*columns).unionByName(often.select(*columns)).where("did != first_did")


def keep_bitmaps(docs: DataFrame, scratch: Scratch, min_chars: int = MIN_CHARS) -> DataFrame:
    """A keep bitmap for each document that loses lines: did, version, keep, n_dropped.

    `keep` maps the number of a 64-line word to its bits, a set bit for a line that
    stays; words without a dropped line are left out, and so are documents without one.
    A document is a doc_id (rows with the same id and text are the same document; a null
    id counts as one document after all others). Lines shorter than `min_chars` stay.
    """
    scratch = scratch.inner()
    lines = scratch.keep(line_hashes(docs, min_chars), name="lines")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("pos") % 64)
    words = (
        repeated_lines(lines, scratch)
        .groupBy("did", "version", F.floor(F.col("pos") / 64).cast("int").alias("word"))
        .agg(F.bit_or(bit).alias("dropped"))
    )
    bitmaps = words.groupBy("did", "version").agg(
        F.map_from_entries(F.collect_list(F.struct("word", F.bitwise_not("dropped")))).alias("keep"),
        F.sum(F.bit_count("dropped")).cast("bigint").alias("n_dropped"),
    )
    bitmaps = scratch.keep(bitmaps, name="bitmaps")
    scratch.discard("lines")
    return bitmaps


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """The rows of `docs` with `n_lines`, `n_dropped` and `kept_text`; columns so named are
    replaced. A null text is one empty line."""
    keyed = docs.drop("n_lines", "n_dropped", "kept_text").withColumns({
        "_did": known_id(F.col("doc_id")), "_version": _version(F.col("text")),
    })
    marks = bitmaps.select(
        F.col("did").alias("_did"), F.col("version").alias("_version"),
        F.col("keep").alias("_keep"), F.col("n_dropped").alias("_dropped"),
    )
    lines = split_lines(F.col("text"))

    def stays(_, place: Column) -> Column:
        word = F.try_element_at(F.col("_keep"), F.floor(place / 64).cast("int"))
        bit = F.call_function("shiftright", word, place % 64).bitwiseAND(F.lit(1).cast("bigint"))
        return F.coalesce(bit == 1, F.lit(True))

    return keyed.join(marks, ["_did", "_version"], "left").withColumns({
        "n_lines": F.size(lines).cast("bigint"),
        "n_dropped": F.coalesce("_dropped", F.lit(0)).cast("bigint"),
        "kept_text": F.when(
            F.col("_keep").isNull(), F.coalesce(F.col("text"), F.lit(""))
        ).otherwise(F.array_join(F.filter(lines, stays), "\n")),
    }).drop("_did", "_version", "_keep", "_dropped")


ORACLE = r"""
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
  from documents
), keyed as (
  select *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from lines
), firsts as (
  select key, min(doc_id) as first_id from keyed where length(key) >= 10 group by key
), judged as (
  select k.doc_id, k.line, k.pos, coalesce(f.first_id <> k.doc_id, false) as dropped
  from keyed k left join firsts f on k.key = f.key and length(k.key) >= 10
)
select doc_id, count(*) as n_lines, count_if(dropped)::bigint as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not dropped), '')) as kept_sha256
from judged group by doc_id
"""
