"""A corpus for training: identify, dedup, decontaminate, mix, and write token ids."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgepulse.llm import decontamination, language, mixing, simhash, token_store
from forgepulse.llm.common import Aside, send_little_at_once, table
from forgepulse.sources.storage import Scratch

# Words a worker remembers when token ids are written: its memory and the executor's have
# served the other stages already.
REMEMBERED = 300_000

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the labelled languages; texts too far from all of them go."""
    send_little_at_once(spark)
    own = Aside(docs, ["text", "lang", "doc_id"])
    return own.back(language.identify(own.df).where(~F.col("rejected")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that links of SimHash connect, the one with the smallest
    doc_id; rows of the group that repeat it stay with it, as do all rows without one.
    Other texts of a doc_id that goes are not touched.
    """
    send_little_at_once(spark)
    groups = simhash.near_duplicates(docs, Scratch(spark))
    # A comparison with null drops nothing.
    dropped = groups.where(F.col("doc_id") != F.col("component_id")).select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")
    ).distinct()
    same = (F.col("doc_id").cast("bigint") == F.col("_id")) & (F.xxhash64("text") == F.col("_hash"))
    own = Aside(docs, ["doc_id", "text"])
    return own.back(own.df.join(dropped, same, "left_anti"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    send_little_at_once(spark)
    own = Aside(docs, ["text"])
    found = decontamination.contaminated(own.df, table(spark, sf_dir, "benchmark"))
    return own.back(found.where(~F.col("contaminated")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    own = Aside(docs, ["doc_id", "text", "source"])
    return own.back(mixing.repeated(mixing.mix(own.df, Scratch(spark)), own.df.columns))


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token files' documents, as read back: doc_id, start, n_tokens, ids_crc32."""
    send_little_at_once(spark)
    path = Scratch(spark).path("tokens")
    token_store.write_tokens(
        docs, path, public_tokenizers.path(token_store.VOCABULARY), remembered=REMEMBERED
    )
    return token_store.described(token_store.read_tokens(spark, path))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate),
    ("source_mixing", mix_sources),
    ("token_output", write_token_ids),
]

# SQL can express neither the language model nor SimHash nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again by the next."""
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), name=name)
    return docs
