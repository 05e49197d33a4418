"""The corpus queries with their SQL, where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from forgepulse.llm import (
    conversation_repair, decontamination, exact_dedup, language, line_dedup, mixing, pii, prefix_trie,
    sentence_pieces, sharding, simhash, token_store, url_filter,
)
from forgepulse.llm.common import table
from forgepulse.sources.storage import Scratch


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    sized = docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    mixed = mixing.mix(sized, Scratch(spark), F.col("size"))
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"),
        "source", "copies",
    )


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages).select(
        "page_id", "host", "path", "rule", "strict_hits", "soft_hits", "verdict"
    )


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard(docs, Scratch(spark)).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs, Scratch(spark))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.contaminated(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "contaminated", "item_ids")


def op6_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = Scratch(spark).path("tokens")
    token_store.write_tokens(docs, path, public_tokenizers.path(token_store.VOCABULARY))
    return token_store.described(token_store.read_tokens(spark, path))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.find_personal_data(docs, with_text=False)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language.identify(docs).select(
        "doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score",
        "rejected",
    )


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    bitmaps = line_dedup.keep_bitmaps(docs, Scratch(spark))
    return line_dedup.apply_bitmaps(docs, bitmaps).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup.equal_texts(docs, Scratch(spark))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.rebuilt(table(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(turns, Scratch(spark))


def op12_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return sentence_pieces.described(docs, public_tokenizers.path(sentence_pieces.VOCABULARY))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversation_repair.damaged(table(spark, sf_dir, "conversations"))
    return conversation_repair.repair(rows, Scratch(spark), gone="gone")


_QUERIES = (
    op1_mixing, op2_url_filter, op3_sharding, op4_simhash, op5_decontamination,
    op6_token_output, op7_pii, op8_language_id, op9_line_dedup, op10_exact_dedup,
    op11_prefix_trie, op12_sentence_pieces, op13_conversation_repair,
)
QUERIES = {query.__name__: query for query in _QUERIES} | {"pipeline": corpus_pipeline.run}
ORACLE = {
    "op1_mixing": mixing.ORACLE,
    "op2_url_filter": url_filter.oracle(),
    "op9_line_dedup": line_dedup.ORACLE,
    "op10_exact_dedup": exact_dedup.ORACLE,
    "op11_prefix_trie": prefix_trie.ORACLE,
    "op13_conversation_repair": conversation_repair.ORACLE,
}
