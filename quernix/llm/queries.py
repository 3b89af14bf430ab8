"""Queries of the operators on texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernix.functions.tokens import bpe_sql
from quernix.llm.leaks import find_leaks, remove_leaked
from quernix.llm.packing import pack
from quernix.llm.pairs import defective_pairs
from quernix.llm.subjects import document_subjects
from quernix.llm.tokenize import encode, token_counts
from quernix.runtime import stage, table

CONTAINER_TOKENS = 2048


def _corpus(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select(F.lit("documents").alias("corpus"), F.col("doc_id").cast("string").alias("record_id"), "text")
    sft = table(spark, sf, "sft_messages").select(F.lit("sft_messages").alias("corpus"), F.col("trajectory_id").alias("record_id"), F.explode("messages.content").alias("text"))
    return docs.unionByName(sft)


def _leaks(spark: SparkSession, sf: str) -> DataFrame:
    found = find_leaks(_corpus(spark, sf), table(spark, sf, "eval_items"))
    return found.join(table(spark, sf, "attempts").select("task_id").distinct(), "task_id", "left_semi")


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return _leaks(spark, sf).select("corpus", "record_id", "task_id")


def p1_matches(spark: SparkSession, sf: str) -> DataFrame:
    return _leaks(spark, sf).select("corpus", "record_id", "task_id", "n_words", "text_word", "item_word")


def p1_clean(spark: SparkSession, sf: str) -> DataFrame:
    """The records of both corpora that nothing leaked into."""
    records = _corpus(spark, sf).select("corpus", "record_id").where("record_id is not null").distinct()
    return remove_leaked(records, _leaks(spark, sf))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return defective_pairs(table(spark, sf, "chat_source"), "trial_name", "conversations")


def p6_ids(spark: SparkSession, sf: str) -> DataFrame:
    return encode(table(spark, sf, "documents"), "doc_id", F.col("text"))


def p7_containers(spark: SparkSession, sf: str) -> DataFrame:
    sizes = stage(token_counts(table(spark, sf, "documents"), "doc_id", F.col("text")), "token-counts")
    return pack(sizes, "doc_id", "n_tokens", CONTAINER_TOKENS)


def p7_placed(spark: SparkSession, sf: str) -> DataFrame:
    """Of each document its number of pieces and tokens, and whether all containers that it is in hold their capacity."""
    placed = stage(p7_containers(spark, sf), "placed")
    fill = placed.where("container_id is not null").groupBy("container_id").agg(F.sum("size").alias("fill"))
    rows = placed.join(fill, "container_id", "left")
    return rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("pieces"), F.sum("size").alias("tokens"), (F.max(F.coalesce("fill", F.lit(0))) <= CONTAINER_TOKENS).alias("fits"))


_ENCODED = f"WITH RECURSIVE src AS (SELECT doc_id AS key, text FROM documents), {bpe_sql('src')}"
P6_IDS_SQL = f"{_ENCODED} SELECT key AS doc_id, ids FROM encoded"
P7_PLACED_SQL = f"{_ENCODED} SELECT key AS doc_id, greatest(1, (len(ids) + {CONTAINER_TOKENS - 1}) // {CONTAINER_TOKENS})::BIGINT AS pieces, len(ids)::BIGINT AS tokens, true AS fits FROM encoded"


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    return document_subjects(table(spark, sf, "documents"), table(spark, sf, "subject_areas"), table(spark, sf, "doc_labels"))


def p8_composition(spark: SparkSession, sf: str) -> DataFrame:
    """Documents and words by subject; a document of several subjects counts in each by an equal part."""
    found = stage(p8_found(spark, sf), "subjects")
    parts = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("k"))
    docs = table(spark, sf, "documents").select("doc_id", F.coalesce("n_chars", F.lit(0)).alias("chars"))
    rows = found.join(parts, "doc_id").join(docs, "doc_id")
    return rows.groupBy("subject").agg(F.count(F.lit(1)).alias("documents"), F.sum(1 / F.col("k")).alias("document_parts"), F.sum(F.col("chars") / F.col("k")).alias("chars"))


QUERIES = {"p1_found": p1_found, "p1_matches": p1_matches, "p1_clean": p1_clean, "p3_found": p3_found, "p6_ids": p6_ids, "p7_containers": p7_containers, "p7_placed": p7_placed, "p8_found": p8_found, "p8_composition": p8_composition}
SQL: dict[str, str] = {"p6_ids": P6_IDS_SQL, "p7_placed": P7_PLACED_SQL}
