"""The queries of the problems tagged llm: p4_, p8_, p9_, p10_, over whole tables and whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm import alike_pairs, encoding, form_sql, leakage, percentiles
from marlstone.sources.tables import table


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return encoding.encode_corpus(table(spark, d, "documents"), "doc_id", "text")


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return p9_evidence(spark, d).select("doc_id", "item_id").distinct()


def p9_evidence(spark: SparkSession, d: str) -> DataFrame:
    """Each leaked run with its place in item and document."""
    found = leakage.leaks(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "heldout_items"), "item_id", "text")
    return found.withColumnsRenamed({"doc": "doc_id", "item": "item_id"})


def p9_proximity(spark: SparkSession, d: str) -> DataFrame:
    """Documents that hold an item's three rarest words within twenty words, in any order."""
    found = leakage.near(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "heldout_items"), "item_id", "text")
    return found.withColumnsRenamed({"doc": "doc_id", "item": "item_id"})


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return alike_pairs.pairs(table(spark, d, "documents"), "doc_id", "text").select(F.col("a").alias("doc_id_a"), F.col("b").alias("doc_id_b"))


def p10_classes(spark: SparkSession, d: str) -> DataFrame:
    return alike_pairs.classes(table(spark, d, "documents"), "doc_id", "text").withColumnRenamed("id", "doc_id")


QUERIES = percentiles.QUERIES | {f.__name__: f for f in (p8_ids, p9_found, p9_evidence, p9_proximity, p10_found, p10_classes)}

SQL: dict[str, str] = percentiles.SQL | form_sql.SQL
