"""Byte-level BPE against the tokenizer library, WARC archives there and back, and the pipeline."""

import base64
import gzip
import hashlib
import io
import random
import sys
from pathlib import Path

import public_tokenizers
import pytest
import tiktoken
from conftest import TESTDATA
from fixtures import awkward, documents
from pyspark.sql import functions as F

import corpus_pipeline
from wardline.llm import bpe, warc
from wardline.llm.common import table
from wardline.llm.queries import RANKS, llm_oracle, llm_queries


@pytest.fixture(scope="module")
def encoding():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def packed(ids):
    return b"".join(i.to_bytes(4, "little") for i in ids)


def test_chunks_encode_like_the_whole(spark, encoding):
    rnd = random.Random(1)
    texts = [*awkward()[:-2], "it's  we're\n\n x", "a" * 300, " " * 200 + "x", "日本語 text é" * 20, "😀" * 50, "<|endoftext|>"]
    texts += ["".join(rnd.choice("ab 's\n\tré1, ") for _ in range(rnd.randint(1, 400))) for _ in range(60)]
    docs = documents(spark, texts)
    for chunk, overlap in ((40, 10), (17, 3)):
        got = bpe.decode(bpe.encode(docs, RANKS, public_tokenizers.PATTERN, chunk=chunk, overlap=overlap), RANKS)
        rows = {r.doc_id: r for r in got.collect()}
        assert len(rows) == len(texts)
        for i, t in enumerate(texts):
            assert bytes(rows[i].ids) == packed(encoding.encode_ordinary(t or "")), (chunk, t)
            assert bytes(rows[i].decoded) == (t or "").encode()
    assert bpe.encode(documents(spark, []), RANKS, public_tokenizers.PATTERN).count() == 0


def test_bpe_query(spark, encoding):
    texts = {r.doc_id: r.text for r in table(spark, TESTDATA, "documents").collect()}
    for r in llm_queries()["op7_byte_bpe"](spark, TESTDATA).collect():
        ids = encoding.encode_ordinary(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(packed(ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def pages(spark):
    big, other = "é" * 600, "x" * 1000
    rows = [
        (1, "http://a/\r\nX: y", big), (2, None, big), (3, "u", "x" * 999), (4, "u", "x" * 999), (5, "u", None),
        (6, "u", ""), (7, "u", other), (7, "u", other), (8, "u", "\r\n\r\n" + other), (None, "u", other), (9, "u", "WARC/1.1\r\n"),
    ]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("keeper", F.lit("clash"))


def test_warc_round_trip(spark, folder):
    where, manifest = warc.write(pages(spark), folder + "/archives")
    rows = warc.read(spark, where, manifest).collect()
    assert len(rows) == pages(spark).count() == manifest.agg(F.sum("records")).first()[0]
    got = {(r.record_key, r.record_type, r.refers_to, r.payload_bytes) for r in rows}
    assert {("1", "revisit", "2", 1200), ("2", "response", None, 1200), ("3", "response", None, 999)} <= got
    assert {("7", "response", None, 1000), (None, "revisit", "7", 1000), ("5", "response", None, 0)} <= got
    by = {r.record_key: r for r in rows}
    assert by["1"].payload is None and by["2"].payload.decode() == "é" * 600
    assert by["1"].payload_digest == hashlib.sha1(("é" * 600).encode()).hexdigest()
    assert by["1"].target_uri == "http://a/%0D%0AX: y" and by["2"].target_uri is None
    where, manifest = warc.write(pages(spark).filter("false"), folder + "/none")
    assert warc.read(spark, where, manifest).count() == 0


def test_each_record_is_one_gzip_member():
    members = [warc.pack(i, "u", bytes([65 + i]) * 3000, None) for i in range(3)]
    assert [gzip.decompress(m)[:8] for m in members] == [b"WARC/1.1"] * 3
    assert [r[0] for r in warc.records(io.BytesIO(b"".join(members)))] == ["0", "1", "2"]


@pytest.mark.parametrize(
    "damage",
    [
        lambda m: m[:-30],
        lambda m: gzip.compress(gzip.decompress(m).replace(b"AAAA", b"AAAB", 1)),
        lambda m: gzip.compress(gzip.decompress(m).replace(b"Content-Length: 3", b"Content-Length: 2", 1)),
        lambda m: gzip.compress(gzip.decompress(m) * 2),
        lambda m: b"plain text" + m,
    ],
)
def test_damaged_archives_are_refused(damage):
    member = warc.pack(1, "u", b"A" * 3000, None)
    with pytest.raises(warc.DamagedArchive):
        list(warc.records(io.BytesIO(damage(member))))


def test_warc_query_matches_sql(spark):
    sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))
    from compare import compare, database

    verdict, _, _ = compare(
        spark, database(TESTDATA), TESTDATA, "op10_warc", llm_queries()["op10_warc"], llm_oracle()["op10_warc"]
    )
    assert verdict.startswith("ok")


def test_pipeline_stages(spark):
    docs = table(spark, TESTDATA, "documents")
    texts = [None, "", "1234 5678", "All of this is a plain text about the weather and the sea today."]
    odd = spark.createDataFrame(
        [(10**6 + i, t, None, None, None) for i, t in enumerate(texts)], docs.schema
    )
    now, columns = docs.union(odd), docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before, now = now, stage(spark, now, TESTDATA)
        assert now.columns == columns and now.schema.simpleString() == docs.schema.simpleString()
        now = corpus_pipeline.stored(now, "test-stage")
        assert now.join(before, "doc_id", "left_anti").count() == 0
    left = {r.doc_id for r in now.collect()}
    assert not {10**6, 10**6 + 1, 10**6 + 2} & left
    last = corpus_pipeline.STAGES[-1][1](spark, now, TESTDATA)
    assert last.count() == len(left) and last.columns[:2] == ["doc_id", "n_tokens"]


def test_every_query_of_the_list_is_registered():
    names = set(llm_queries())
    assert {n.split("_")[0] for n in names} == {*(f"op{i}" for i in range(1, 14)), "pipeline"}
    assert set(llm_oracle()) <= names
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "line_dedup", "ngram_jaccard", "decontamination", "byte_bpe"
    ]
