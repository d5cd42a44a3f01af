"""Joins on pairs against brute force over all pairs."""

import random
import re
import string
import time

import numpy as np
import pyarrow as pa
from fixtures import awkward, documents, words

from wardline.llm import jaccard, lines, pivots, tiling
from wardline.llm.components import components
from wardline.llm.words import Words

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def edited(rnd, text, n, stock=40):
    out = text.split(" ")
    for _ in range(n):
        i = rnd.randrange(len(out))
        out[i : i + rnd.randint(0, 1)] = [f"w{rnd.randrange(stock)}"] * rnd.randint(0, 1)
    return " ".join(out)


def groups(n, links):
    up = list(range(n))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def shingles(text, n):
    w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def jaccard_brute(texts, n, percent):
    sets = [shingles(t, n) for t in texts]
    links = [
        (i, j)
        for i in range(len(sets))
        for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    ]
    return [len(s) for s in sets], groups(len(sets), links)


def near_texts(rnd, count, sizes, edits):
    base = [words(rnd, rnd.choice(sizes), 10_000) for _ in range(count)]
    shared = words(rnd, 60, 10_000)
    out = []
    for b in base:
        out += [edited(rnd, b, rnd.randint(0, edits)) for _ in range(rnd.randint(1, 12))]
        out.append(b + " " + shared)
    return out


def test_jaccard_join(spark):
    rnd = random.Random(4)
    texts = awkward() + near_texts(rnd, 12, (1, 3, 5, 12, 60, 150, 210, 240, 400), 8)
    texts += ["A b c\x0bD e f", "a b C d\te F"]
    for n, percent in ((4, 85), (5, 80)):
        got = {r.doc_id: r for r in jaccard.join_classes(documents(spark, texts), n, percent).collect()}
        sizes, roots = jaccard_brute(texts, n, percent)
        assert [got[i].n_shingles for i in range(len(texts))] == sizes
        assert [got[i].component_id for i in range(len(texts))] == roots


def test_jaccard_frequent_tokens_and_small_blocks(spark, monkeypatch):
    """Every token frequent: pairs alone must find all links; blocks of a few sets must agree."""
    monkeypatch.setattr(jaccard, "BLOCK", 300)
    monkeypatch.setattr(jaccard, "_levels", lambda sizes, bits: (np.full(1 << bits, 9, np.uint8), 9))
    rnd = random.Random(9)
    texts = near_texts(rnd, 5, (60, 100, 170, 190, 205, 230), 10)
    got = {r.doc_id: r.component_id for r in jaccard.join_classes(documents(spark, texts), 4, 85).collect()}
    assert [got[i] for i in range(len(texts))] == jaccard_brute(texts, 4, 85)[1]


def test_jaccard_null_and_repeated_ids(spark):
    docs = documents(spark, ["a b c d e f", "a b c d e f", "q r s t u v"])
    odd = docs.selectExpr("nullif(doc_id, 1) as doc_id", "text").union(docs.filter("doc_id = 2").select("doc_id", "text"))
    got = sorted(jaccard.join_classes(odd, 4, 85).collect(), key=str)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.component_id) for r in got if r.doc_id is not None) == [
        (False, 0, 0), (False, 2, 2), (False, 2, 2)
    ]
    assert [r.component_id for r in got if r.doc_id is None] == [None]
    assert jaccard.join_classes(documents(spark, []), 4, 85).count() == 0


def test_parity_never_loses_a_link():
    rnd = np.random.default_rng(3)
    for _ in range(200):
        n = int(rnd.integers(2, 400))
        a = rnd.integers(0, 2**63, n, dtype=np.uint64)
        b = np.unique(np.concatenate([a[: n - int(rnd.integers(0, n // 4 + 1))], rnd.integers(0, 2**63, int(rnd.integers(0, n // 4 + 1)), dtype=np.uint64)]))
        a = np.unique(a)
        c = len(np.intersect1d(a, b))
        if 100 * c >= 85 * (len(a) + len(b) - c):
            alive = jaccard.may_link(np.array([len(a), len(b)]), [jaccard.parity(a), jaccard.parity(b)], np.array([0]), np.array([1]), 85)
            assert alive.all()


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def mutated(rnd, s, n, alphabet):
    s = list(s)
    for _ in range(n):
        i = rnd.randrange(len(s) + 1)
        s[i : i + rnd.randint(0, 1)] = [rnd.choice(alphabet)] * rnd.randint(0, 1)
    return "".join(s)


def test_banded_distance():
    rnd = random.Random(4)
    for _ in range(8000):
        a = "".join(rnd.choice("abcdef"[: rnd.choice((2, 6))]) for _ in range(rnd.randint(0, 25)))
        b, k = mutated(rnd, a, rnd.randint(0, 5), "abc"), rnd.randint(1, 3)
        assert lines.distance(a, b, k) == min(plain_distance(a, b), k + 1)


def test_line_keys_hash_each_place_once(monkeypatch):
    hashed, seen = lines.xxhash.xxh3_64_intdigest, []
    monkeypatch.setattr(lines.xxhash, "xxh3_64_intdigest", lambda part, seed: seen.append((part, seed)) or hashed(part, seed))
    for line in ["abcdefghij", "the quick brown fox jumps", "für größere Zeilen über 20 Zeichen", "a" * 40, "short"]:
        seen.clear()
        keys = lines.line_keys(line)
        assert len(seen) == len(lines._probe_places(len(line))) and len(keys) == len(set(seen))
        own = {hashed(line[a:b].encode(), len(line) * 8 + i) for i, a, b in lines._own_places(len(line))}
        assert own <= set(keys)


def test_line_keys_of_one_line_are_not_stored(spark):
    """Keys move once: rows of a key that no other line has end there, repeats of one line included."""
    rows = [(1, 10), (1, 11), (2, 10), (3, 12), (3, 12), (4, 11), (4, 10), (4, 10)]
    shared = lines._shared(spark.createDataFrame(rows, "key long, id long"))
    assert shared._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(key") == 1
    assert set(map(tuple, shared.collect())) == {(1, 10), (1, 11), (4, 11), (4, 10)}


def test_line_classes(spark, monkeypatch):
    monkeypatch.setattr(lines, "BLOCK", 400)
    rnd = random.Random(6)
    base = ["".join(rnd.choice("abcd ") for _ in range(rnd.randint(3, 45))) for _ in range(8)]
    texts = awkward() + [
        "\n".join(mutated(rnd, rnd.choice(base), rnd.randint(0, 3), "abcd").upper() for _ in range(rnd.randint(1, 8)))
        for _ in range(25)
    ]
    occurrences = [(i, k, lines.normal(x)) for i, t in enumerate(texts) for k, x in enumerate((t or "").split("\n"))]
    distinct = sorted({x for _, _, x in occurrences if x})
    links = [
        (i, j)
        for i, a in enumerate(distinct)
        for j, b in enumerate(distinct[:i])
        if abs(len(a) - len(b)) <= 2 and lines.distance(a, b, 2) <= lines.edits(min(len(a), len(b)))
    ]
    root = dict(zip(distinct, groups(len(distinct), links)))
    degree = {x: sum(i in p for p in links) for i, x in enumerate(distinct)}
    first = {}
    for i, k, x in occurrences:
        if x:
            first.setdefault(root[x], (i, k))
    docs = documents(spark, texts)
    got = {(r.doc_id, r.line_no): r for r in lines.line_classes(docs).collect()}
    assert len(got) == len(occurrences)
    for i, k, x in occurrences:
        r = got[i, k]
        where = first[root[x]] if x else (None, None)
        assert (r.class_doc_id, r.class_line_no) == where
        assert r.kept == (not x or where == (i, k)) and r.n_links == (degree[x] if x else 0)
    left = {r.doc_id: r for r in lines.dedup_lines(docs).collect()}
    for i, t in enumerate(texts):
        kept = [x for k, x in enumerate((t or "").split("\n")) if got[i, k].kept]
        lost = len(kept) < len((t or "").split("\n"))
        if lost and not any(x.strip() for x in kept):
            assert i not in left
        else:
            assert left[i].text == "\n".join(kept) and left[i].n_chars == len(left[i].text)
    assert lines.dedup_lines(documents(spark, [])).columns == docs.columns


def tiles_brute(p, t, least):
    pm, tm, covered = [False] * len(p), [False] * len(t), 0
    while True:
        best, found = 0, []
        for i in range(len(p)):
            for j in range(len(t)):
                k = 0
                while i + k < len(p) and j + k < len(t) and p[i + k] == t[j + k] and not pm[i + k] and not tm[j + k]:
                    k += 1
                if k > best and k >= least:
                    best, found = k, []
                if k and k == best:
                    found.append((i, j))
        if best < least:
            return covered
        for i, j in found:
            if not any(pm[i : i + best]) and not any(tm[j : j + best]):
                pm[i : i + best] = tm[j : j + best] = [True] * best
                covered += best


def test_tiles():
    rnd = random.Random(2)
    for _ in range(600):
        p = [rnd.randint(1, 3) for _ in range(rnd.randint(1, 14))]
        t = [rnd.randint(1, 3) for _ in range(rnd.randint(0, 20))]
        least = min(tiling.SEED, len(p))
        assert sum(k for k, _, _ in tiling.tiles(p, t, least)) == tiles_brute(p, t, least)


def test_tiles_of_repetitive_text_are_bounded():
    rnd = random.Random(7)
    for n, stock in ((40, 1), (60, 2), (60, 3)):
        for _ in range(15):
            p, t = ([rnd.randint(1, stock) for _ in range(k)] for k in (n, 2 * n))
            assert sum(k for k, _, _ in tiling.tiles(p, t, 4)) == tiles_brute(p, t, 4)
    start = time.monotonic()
    assert tiling.coverage([5] * 500, [5] * 50_000) == 1.0
    assert tiling.coverage([5, 6] * 250, [6, 5] * 25_000) == 1.0
    assert time.monotonic() - start < 6


def thue_morse(n):
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_words_that_linear_hashes_confuse(spark):
    texts, items = [], []
    for n in (1024, 2048, 4096, 8192):
        a, b = thue_morse(n)
        texts += [a, b, f"x {a} y z", f"x {b} y z"]
        items.append(f"one {b} two three four")
    rows = jaccard.join_classes(documents(spark, texts), 4, 85).collect()
    assert all(r.component_id == r.doc_id and r.n_shingles == 1 for r in rows)
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = documents(spark, [f"one {thue_morse(n)[0]} two three four" for n in (1024, 4096)] + items[:1])
    got = {r.doc_id: r["items"] for r in tiling.leaks(docs, benchmark).collect()}
    assert got == {0: [], 1: [], 2: [0]}


def test_long_words_hash_by_content():
    base = "".join(random.Random(n).choice("abc") for n in range(400))
    made = {base[:n] for n in range(1, 400)} | {base[:n] + "z" + base[n + 1 :] for n in range(400)}
    assert len(set(Words(pa.array(sorted(made))).hash.tolist())) == len(made)


def test_leaks(spark):
    rnd = random.Random(12)
    items = [words(rnd, n, 300) for n in (1, 3, 4, 9, 20, 35, 60)] + [None, "", "..."]
    benchmark = spark.createDataFrame(
        [(i, t, "x") for i, t in enumerate(items)] + [(4, items[4], "again"), (None, words(rnd, 30, 300), "x")],
        "item_id long, text string, doc_id string",
    )
    texts = awkward()
    for item in items[2:7]:
        w = item.split(" ")
        half = len(w) // 2
        texts.append(f"{words(rnd, 20, 9000)} {' '.join(w).upper()}! {words(rnd, 9, 9000)}")
        texts.append(f"{words(rnd, 5, 9000)}, {' '.join(w[half:])}; {words(rnd, 9, 9000)} {' '.join(w[:half])}")
        texts.append(f"{words(rnd, 20, 9000)} {' '.join(w[: half + 1])}")
    texts += [words(rnd, 400, 300) for _ in range(10)]
    split = lambda t: re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (t or "").lower())
    tokens = {i: split(t) for i, t in enumerate(items) if split(t)}
    got = {r.doc_id: r for r in tiling.leaks(documents(spark, texts), benchmark).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        own = split(t)[:3000]
        share = {j: tiles_brute(p, own, min(tiling.SEED, len(p))) / len(p) for j, p in tokens.items()}
        assert got[i]["items"] == [j for j, s in share.items() if s >= 0.8 - 1e-9], (i, share)
        assert got[i].contaminated == bool(got[i]["items"])
    assert tiling.leaks(documents(spark, texts), benchmark.filter("false")).filter("contaminated").count() == 0
    assert tiling.leaks(documents(spark, []), benchmark).count() == 0


def test_near_vectors_that_share_an_id(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [0.0, 1.0], 2), (2, [1.0, 0.01], 1), (3, [0.01, 1.0], 2), (None, [1.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted((str(r.vec_id), r.n_links, r.component_id) for r in pivots.near_vectors(df).collect())
    assert got == [("1", 1, 1), ("1", 1, 1), ("2", 1, 1), ("3", 1, 1), ("None", 0, None)]
    assert pivots.near_vectors(df.filter("false")).count() == 0


def test_near_vectors(spark, monkeypatch):
    monkeypatch.setattr(pivots, "BLOCK", 40)
    rnd = np.random.default_rng(5)
    centers = rnd.normal(size=(40, 16))
    x = centers[rnd.integers(0, 40, 500)] + rnd.normal(size=(500, 16)) * rnd.choice([0.05, 0.25], (500, 1))
    x[100:160] = x[100]
    label = rnd.integers(0, 3, 500)
    rows = [(i, [float(v) for v in r], int(c)) for i, (r, c) in enumerate(zip(x, label))]
    odd = [None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [1.0, 2.0]]
    rows += [(500 + i, v, 1) for i, v in enumerate(odd)] + [(600, rows[0][1], None), (None, rows[0][1], int(label[0]))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: r for r in pivots.near_vectors(df).collect()}
    assert len(got) == len(rows)
    y = x.astype(np.float32).astype(float)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    near = (y @ y.T >= 0.93) & (label[:, None] == label[None, :]) & ~np.eye(500, dtype=bool)
    links = np.array([got[i].n_links for i in range(500)])
    assert (links <= near.sum(1)).all() and links.sum() >= 0.97 * near.sum()
    roots = groups(500, [(int(i), int(j)) for i, j in zip(*np.nonzero(near))])
    assert sum(got[i].component_id == roots[i] for i in range(500)) >= 490
    for i in [*range(500, 507), 600]:
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert (got[None].n_links, got[None].component_id, got[None].kept) == (0, None, False)
    assert pivots.near_vectors(df.filter("false")).count() == 0


def test_components_of_a_long_chain(spark):
    chain = [(i, i + 1) for i in range(200)] + [(1000, 1001), (7, 7)]
    edges = spark.createDataFrame(random.Random(1).sample(chain, len(chain)), "a long, b long")
    got = {r.id: r.component for r in components(edges).collect()}
    assert all(got[i] == 0 for i in range(201)) and got[1001] == got[1000] == 1000
    assert components(edges.filter("false")).count() == 0
