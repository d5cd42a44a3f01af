"""From raw documents to token ids: the corpus operators in the order a training run needs them.

Each stage takes what the one before kept, written as Parquet and read again. All but the last
return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm import jaccard, langid, lines, tiling
from wardline.llm.common import held_out, stored, table
from wardline.llm.queries import token_digests

#: Near-duplicates share 80 % of their five-word shingles.
SHINGLE, PERCENT = 5, 80


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or in which no language has half of the text, go."""
    return langid.accepted(docs, langid.train(docs, ~held_out(F.col("doc_id"))))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one go, and documents left without a line."""
    return lines.dedup_lines(docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one row stays, one with the smallest doc_id.

    Rows are told apart by their place in the stored input, so ids may repeat or be null.
    """
    rows = docs.withColumn("_row", F.monotonically_increasing_id())
    classes = jaccard.join_classes(rows.select(F.col("_row").alias("doc_id"), "text"), SHINGLE, PERCENT)
    several = classes.groupBy("component_id").agg(F.count("*").alias("n")).filter("n > 1")
    grouped = stored(classes.join(several, "component_id").select(F.col("doc_id").alias("_row"), "component_id"), "groups")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row"))
    kept = grouped.join(rows.select("_row", "doc_id"), "_row").groupBy("component_id").agg(first["_row"].alias("_row"))
    gone = grouped.join(kept, ["component_id", "_row"], "left_anti").select("_row")
    return rows.join(gone, "_row", "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of `benchmark`, in whatever order of its passages, go."""
    found = tiling.leaks(docs, table(spark, sf_dir, "benchmark")).filter("contaminated")
    bad = found.select(F.col("doc_id").alias("_doc_id"), F.col("text_hash").alias("_text_hash")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.xxhash64("text") == F.col("_text_hash"))
    return docs.join(bad, same, "left_anti")


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document that is left."""
    return token_digests(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("ngram_jaccard", ngram_jaccard),
    ("decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]

#: The mixtures, edit distances and merges of the stages are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
