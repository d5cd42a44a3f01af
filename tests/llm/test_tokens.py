"""Piece encoding against the library, alignment against brute force, clustering against plain rounds."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from conftest import TESTDATA
from fixtures import awkward, documents
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wardline.llm import alignment, nsbounds, pieces
from wardline.llm.common import table
from wardline.llm.queries import BYTE_BPE, PIECES, llm_queries


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def byte_level():
    out = Tokenizer.from_file(BYTE_BPE)
    out.encode_special_tokens = True
    return out


@pytest.fixture(scope="module")
def coder():
    with open(PIECES, "rb") as f:
        return pieces.Pieces(f.read())


STRANGE = [
    "<s> </s> <unk> <0x41>", "▁ marks ▁▁ of ▁its own", "日本語のテキスト と 中文", "😀👍🏽 é é  \u0085", "\x00a\n\t\r\n b",
    "def f(x):\n        return  x\n", "aaaaaaaaaa" * 30, "<|endoftext|> plain", "it's we'll 1234567 --- ...",
]


def noise(rnd, n):
    stock = ["ab ", " ▁the cat", "aAbB01+/=", "日本語中国人", "éèñöß ", "\n\t\x00 x", "abab", "etaoinshrdlu", "😀🏽a ", " "]
    return ["".join(rnd.choice("".join(rnd.sample(stock, 2))) for _ in range(rnd.randint(0, 90))) for _ in range(n)]


def test_merge_rounds_equal_the_library(coder, library):
    texts = [*STRANGE, *noise(random.Random(5), 1500)]
    for end in (False, True):
        got = coder.encode(texts, end)
        for t, ids in zip(texts, got):
            assert np.frombuffer(ids, "<i4").tolist() == library.encode(t, add_eos=end), t


def test_long_words_and_runs_of_spaces(coder, library):
    rnd = random.Random(2)
    for t in ("x" * 50_000, " " * 30_000, "".join(rnd.choice("etaoin") for _ in range(20_000)), "中" * 9_000):
        assert np.frombuffer(coder.encode([t], False)[0], "<i4").tolist() == library.encode(t)


def test_small_blocks_of_symbols(coder, library, monkeypatch):
    monkeypatch.setattr(pieces, "_FLAT", 7)
    coder.known.clear()
    texts = noise(random.Random(8), 200)
    for t, ids in zip(texts, coder.encode(texts, False)):
        assert np.frombuffer(ids, "<i4").tolist() == library.encode(t)


def test_decoding_equals_the_library(coder, library):
    rnd = random.Random(3)
    for _ in range(4000):
        some = [rnd.choice([rnd.randrange(32_000), rnd.randrange(259), 259, 28_705]) for _ in range(rnd.randint(0, 8))]
        assert coder.decode(some) == library.decode(some), some


def test_piece_frames(spark, library):
    texts = [*awkward(), *STRANGE, None, "same text twice over"]
    docs = documents(spark, texts).withColumn("ids", F.lit("clash")).withColumn("decoded", F.lit(1))
    docs = docs.withColumn("doc_id", F.when(F.col("doc_id") != 3, F.col("doc_id")))
    got = pieces.decode(pieces.encode(docs, PIECES, end=True), PIECES).collect()
    assert len(got) == len(texts)
    want = sorted((library.encode(t or "", add_eos=True), i if i != 3 else None) for i, t in enumerate(texts))
    assert sorted(((list(r.ids), r.doc_id) for r in got), key=str) == sorted(want, key=str)
    assert all(r.decoded == library.decode(list(r.ids)) for r in got)
    assert pieces.encode(documents(spark, []), PIECES).count() == 0


def test_piece_query(spark, library):
    texts = {r.doc_id: r.text or "" for r in table(spark, TESTDATA, "documents").collect()}
    rows = llm_queries()["op12_sentencepiece"](spark, TESTDATA).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id], add_eos=True)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_stretches_of_equal_ends():
    a = np.arange(1, 71)
    for n in range(1, 71):
        b = np.where(a <= n, a, a + 1000)
        assert alignment.matching(a.tobytes(), b.tobytes(), 0, 0, 70) == n
        assert alignment.matching(a.tobytes(), a[70 - n :].tobytes(), 70 - n, 0, n) == n


def test_lookup():
    rnd = np.random.default_rng(3)
    keys = np.unique(rnd.integers(0, 1 << 40, 5000))
    look = pieces.Lookup(keys)
    assert (look(keys) == np.arange(len(keys))).all()
    other = np.setdiff1d(rnd.integers(0, 1 << 40, 5000), keys)
    assert (look(other) == -1).all() and (pieces.Lookup(keys[:0])(keys) == -1).all()


def test_alignment_equals_brute_force():
    rnd = random.Random(4)
    for _ in range(300):
        last = rnd.randint(1, 120)
        a, b = (np.array(sorted({*rnd.choices(range(1, last + 1), k=rnd.randint(0, last)), last})) for _ in range(2))
        runs, *irregular = alignment.align(a, b)
        starts = [(0, *s[:-1]) for s in (a, b)]
        links = {
            (i, j) for i in range(len(a)) for j in range(len(b))
            if max(starts[0][i], starts[1][j]) < min(a[i], b[j])
        }
        left, right = alignment.linked(runs, *irregular)
        assert len(left) == len(links) and set(zip(left.tolist(), right.tolist())) == links
        n_a, n_b = alignment.groups(runs)
        assert len(n_a) == len(set(a) & set(b)) and (n_a.sum(), n_b.sum()) == (len(a), len(b))


def brute(texts, byte_level, library):
    """Every text's tokens, groups and links, straight from the definition."""
    of = alignment.byte_of_char()
    docs = []
    for t in texts:
        whole = (" " + t).encode() if t else b""
        a = byte_level.encode(" " + t, add_special_tokens=False).ids if t else []
        b = library.encode(t) if t else []
        raw_a = [bytes(of[c] for c in byte_level.id_to_token(i)) for i in a]
        raw_b = [
            bytes([int(p[3:5], 16)]) if library.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in zip(b, map(library.id_to_piece, b))
        ]
        if b"".join(raw_a) != whole or b"".join(raw_b) != whole or not t:
            docs.append(([], [], [], []))
            continue
        ends = [np.cumsum([len(r) for r in raw]).tolist() for raw in (raw_a, raw_b)]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups, links, i, j = [], [], 0, 0
        for cut in cuts:
            p, q = ends[0].index(cut) + 1, ends[1].index(cut) + 1
            groups.append((a[i:p], b[j:q]))
            for x in range(i, p):
                for y in range(j, q):
                    low = max(ends[0][x] - len(raw_a[x]), ends[1][y] - len(raw_b[y]))
                    if low < min(ends[0][x], ends[1][y]):
                        links.append((a[x], b[y]))
            i, j = p, q
        docs.append((a, b, groups, links))
    held, best = {}, {}
    for *_, links in docs:
        for pair in set(links):
            held[pair] = held.get(pair, 0) + 1
    for (a, _), n in held.items():
        best[a] = max(best.get(a, 0), n)
    for a, b, groups, links in docs:
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        yield (
            len(a), len(b), len(groups), len(links), hashlib.sha256(text.encode()).hexdigest() if a else "",
            sum(held[p] == best[p[0]] for p in links), sum(held[p] for p in links),
        )


def values(r):
    return r.n_a, r.n_b, r.n_groups, r.n_links, r.groups_sha256, r.n_best, r.count_sum


@pytest.mark.parametrize("shard", [1, 300, alignment.SHARD])
def test_aligned_documents(spark, byte_level, library, monkeypatch, shard):
    monkeypatch.setattr(alignment, "_DIRECT", 100)
    monkeypatch.setattr(alignment, "_PARTS", 7)
    texts = [*awkward()[:-2], "x" * 500, *STRANGE, *noise(random.Random(6), 60)]
    docs = documents(spark, texts).withColumn("pair", F.lit("clash")).withColumn("shard", F.lit("clash"))
    rows = alignment.aligned(docs, BYTE_BPE, public_tokenizers.PATTERN, PIECES, shard).collect()
    assert len(rows) == len(texts)
    want = list(brute(texts, byte_level, library))
    for r in rows:
        assert values(r) == want[r.doc_id], texts[r.doc_id]


def test_alignment_edges(spark):
    empty = alignment.aligned(documents(spark, []), BYTE_BPE, public_tokenizers.PATTERN, PIECES)
    assert empty.count() == 0
    docs = documents(spark, ["one text", "one text", None])
    docs = docs.withColumn("doc_id", F.lit(None).cast("long"))
    rows = alignment.aligned(docs, BYTE_BPE, public_tokenizers.PATTERN, PIECES).collect()
    assert sorted(r.n_links for r in rows) == [0, 2, 2] and all(r.count_sum == 2 * r.n_links for r in rows)


def test_alignment_query(spark, byte_level, library):
    texts = {r.doc_id: r.text for r in table(spark, TESTDATA, "documents").collect()}
    want = dict(zip(texts, brute(texts.values(), byte_level, library)))
    rows = llm_queries()["op13_tokenizer_alignment"](spark, TESTDATA).collect()
    assert {r.doc_id: values(r) for r in rows} == want


def plain_rounds(x, ids, k, rounds, seed="3"):
    """The clustering as defined: every distance in every round."""
    hashes = [hashlib.sha256(f"{seed}:{i}".encode()).hexdigest() for i in ids]
    c = x[sorted(range(len(x)), key=hashes.__getitem__)[:k]].copy()
    for turn in range(rounds + 1):
        d = ((x[:, None, :] - c[None]) ** 2).sum(2)
        own = d.argmin(1)
        if turn == rounds:
            return own, d[np.arange(len(x)), own], c
        for j in range(len(c)):
            if (own == j).any():
                c[j] = x[own == j].sum(0) // int((own == j).sum())


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, x string, cluster string")


def check_clusters(rows, ids, x, k, rounds):
    own, d, c = plain_rounds(x, ids, k, rounds)
    got = {r.vec_id: r for r in rows}
    assert len(rows) == len(ids)
    for i, v in enumerate(ids):
        r = got[v]
        assert (r.cluster, r.distance) == (own[i], d[i])
        assert r.inertia == d.sum() and r.cluster_inertia == d[own == own[i]].sum()
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, c[own[i]].tolist())).encode()).hexdigest()


def test_clusters_equal_plain_rounds(spark):
    rnd = np.random.default_rng(1)
    for n, spread in ((700, 0.05), (300, 1.0), (5, 0.3)):
        e = (rnd.integers(0, 6, n)[:, None] * spread + rnd.normal(size=(n, 64)) * 0.1).astype(np.float32)
        x = np.floor(1024 * e.astype(float)).astype(np.int64)
        rows = nsbounds.cluster(vectors(spark, [(i, v.tolist(), 1, "x", "c") for i, v in enumerate(e)])).collect()
        check_clusters(rows, list(range(n)), x, 8, 10)


def test_cluster_ties_repeats_and_bad_vectors(spark):
    zero, one = [0.0] * 4, [1.0, 0.0, 0.0, 0.0]
    rows = [(i, zero if i % 2 else one, None, None, None) for i in range(12)]
    bad = [(100, None), (101, []), (102, [1.0]), (103, [1.0, None, 0.0, 0.0]), (104, [float("nan")] * 4), (105, [float("inf"), 0.0, 0.0, 0.0])]
    odd = [(7, [0.5, 0.5, 0.0, 0.0], None, None, None), (None, one, None, None, None)]
    df = vectors(spark, rows + odd + [(i, v, None, None, None) for i, v in bad])
    got = nsbounds.cluster(df, 3, 4, 4, 4).collect()
    assert sorted(str(r.vec_id) for r in got) == sorted([*map(str, range(12)), "7", "None"])
    assert nsbounds.cluster(df.filter("vec_id > 99")).count() == 0
    # Equal first centroids: the smaller number has all, the other stays as it is.
    same = nsbounds.cluster(vectors(spark, [(i, one, 1, "", "") for i in range(5)]), 2, 3, 4, 4).collect()
    assert {(r.cluster, r.distance, r.inertia) for r in same} == {(0, 0, 0)}


def test_bounds_save_distances():
    rnd = np.random.default_rng(2)
    x = (rnd.integers(0, 8, 2000)[:, None] * 300 + rnd.integers(0, 60, (2000, 16))).astype(np.int64)
    c = x[:8].copy()
    history, bounds, took = c[None].copy(), nsbounds.first_bounds(x, c), 0
    for _ in range(6):
        own = bounds["own"]
        for j in range(8):
            if (own == j).any():
                c[j] = x[own == j].sum(0) // int((own == j).sum())
        history = np.concatenate((history, c[None].copy()))
        took += nsbounds.next_bounds(x, bounds, history)
        assert (bounds["own"] == ((x[:, None] - c[None]) ** 2).sum(2).argmin(1)).all()
    assert took < 6 * 2000 * 8 / 3


def test_cluster_query(spark):
    e = table(spark, TESTDATA, "embeddings").collect()
    x = np.floor(1024 * np.array([r.embedding for r in e], float)).astype(np.int64)
    rows = llm_queries()["op11_ns_bounds"](spark, TESTDATA).collect()
    check_clusters(rows, [r.vec_id for r in e], x, 8, 10)


def test_too_large_components_are_refused(spark):
    with pytest.raises(Exception, match="too large"):
        nsbounds.cluster(vectors(spark, [(1, [1e9] * 64, 1, "", "")])).collect()
