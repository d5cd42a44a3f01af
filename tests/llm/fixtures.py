"""Small tables with the awkward cases every corpus operator has to survive."""

import random

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use for columns of their own.
        T.StructField("key", T.StringType()),
        T.StructField("id", T.LongType()),
        T.StructField("row", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("component", T.LongType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("spans", T.StringType()),
    ]
)


def documents(spark, texts, first=0):
    rows = [
        (first + i, t, "en", None, None if t is None else len(t), "k", 1, 2, 3, 4, 0.5, "s")
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, DOCS)


def words(rnd: random.Random, n: int, stock: int = 40) -> str:
    return " ".join(f"w{rnd.randrange(stock)}" for _ in range(n))


def awkward() -> list:
    long = "lorem ipsum dolor " * 8000
    return [None, "", " ", "\n\n", "a", "é", "...", "same text twice over", "same text twice over", long, "x" * 50_000]
