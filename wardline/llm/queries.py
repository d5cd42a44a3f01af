"""The corpus operators as registered queries: each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, bpe, jaccard, langid, lines, nsbounds, pieces, pii, pivots, rules, secrets, tiling, warc
from .common import held_out, table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def token_digests(docs: DataFrame) -> DataFrame:
    """Per document its ids, their number and the digests of ids and decoded bytes."""
    both = bpe.decode(bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS)
    return both.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"))


def span_digests(found: DataFrame, kinds: tuple[str, ...], base: int) -> DataFrame:
    """The digest columns of a span query: the first `base` kinds count and are hashed."""
    fixed = F.filter("spans", lambda s: s["kind_no"] < base)

    def number(kind_no: int) -> Column:
        # A lambda with a second parameter, even one with a default, gets the element's place in it.
        return F.size(F.filter("spans", lambda s: s["kind_no"] == kind_no)).cast("long")

    counts = [number(i).alias(f"n_{kind}") for i, kind in enumerate(kinds[:base])]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(secrets.joined(fixed), 256).alias("base_sha256"),
        secrets.joined(F.col("spans")).alias("spans"),
    )


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return span_digests(pii.scan(docs, pii.train(docs)), pii.KINDS, pii.BASE)


def op2_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    model = rules.train(docs, labels.filter(~held_out(F.col("doc_id"))))
    return rules.score(docs, model, ["doc_id"]).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )


def op3_pivot_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.near_vectors(table(spark, sf_dir, "embeddings"))


def op4_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contaminated documents, each with the items it leaks; clean ones have no row."""
    found = tiling.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.filter("contaminated").drop("text_hash")


def op5_token_combinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join_classes(table(spark, sf_dir, "documents"), 4, 85)


def op6_segment_edit_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_classes(table(spark, sf_dir, "documents")).drop("text_hash")


def op8_language_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs, ~held_out(F.col("doc_id")))
    return langid.predict(docs, model, ["doc_id"]).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    ratios = secrets.train(docs)
    least = secrets.threshold(docs, ratios).ratio
    return span_digests(secrets.scan(docs, ratios, least=least), secrets.KINDS, 3)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, manifest = warc.write(table(spark, sf_dir, "pages"))
    return warc.read(spark, folder, manifest, payloads=False).select(
        F.col("record_key").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


OP10_SQL = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS b, coalesce(html, '') AS h FROM pages
), k AS (
  SELECT h, max(page_id) AS keeper FROM p WHERE octet_length(b) >= 1000 GROUP BY h HAVING count(*) > 1
)
SELECT page_id, octet_length(b) AS payload_bytes, sha1(h) AS payload_digest,
       CASE WHEN keeper IS NULL OR page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN keeper IS NULL OR page_id = keeper THEN NULL ELSE keeper END AS refers_to
FROM p LEFT JOIN k USING (h)
"""


def op11_ns_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nsbounds.cluster(table(spark, sf_dir, "embeddings"))


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = pieces.decode(pieces.encode(table(spark, sf_dir, "documents"), PIECES, end=True), PIECES)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned(table(spark, sf_dir, "documents"), BYTE_BPE, public_tokenizers.PATTERN, PIECES)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_pii": op1_pii,
        "op2_rule_ensemble": op2_rule_ensemble,
        "op3_pivot_index": op3_pivot_index,
        "op4_string_tiling": op4_string_tiling,
        "op5_token_combinations": op5_token_combinations,
        "op6_segment_edit_join": op6_segment_edit_join,
        "op7_byte_bpe": op7_byte_bpe,
        "op8_language_shares": op8_language_shares,
        "op9_secrets": op9_secrets,
        "op10_warc": op10_warc,
        "op11_ns_bounds": op11_ns_bounds,
        "op12_sentencepiece": op12_sentencepiece,
        "op13_tokenizer_alignment": op13_tokenizer_alignment,
        "pipeline": pipeline,
    }


def llm_oracle() -> dict[str, str]:
    return {"op10_warc": OP10_SQL}
