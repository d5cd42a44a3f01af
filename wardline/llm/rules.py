"""Text quality by a sparse rule ensemble.

Boosted small trees over text statistics are taken apart: every path from a root becomes a rule,
a conjunction of comparisons. A lasso logistic regression keeps few of them, and what is left is
compiled into one Spark column expression over the statistics.

Statistics of null and empty texts are 0, so those get a score as well. Repeated rows and null
ids give a row each. With no labelled rows the score is 0.5; with one class only, near that class.
Repeated labels of a document count by their mean. Score inputs are statistics of the text alone.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, record, slices

#: Labelled rows used for fitting, at most; the smallest id hashes are taken.
MOST_LABELLED = 20_000
TREES, DEPTH, BINS, RATE = 30, 3, 32, 0.3
STATISTICS = (
    "n_chars", "n_words", "word_length", "upper_share", "digit_share", "mark_share", "symbol_share",
    "pipe_per_word", "exclamation_per_word", "non_ascii_share", "space_share", "unique_words",
    "top_word_share", "repeated_next", "unique_pairs", "n_lines", "line_length", "repeated_lines",
    "marked_word_share", "short_word_share",
)
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#$%&*+<=>@\\^_`{|}~")] = True
_MARKS = np.array([33 <= b < 127 and not chr(b).isalnum() for b in range(256)])


def statistics(text: str) -> list[float]:
    """The values of `STATISTICS` for a whole text."""
    words = text.split()
    if not words:
        return [float(len(text))] + [0.0] * (len(STATISTICS) - 1)
    raw = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256)
    n, size, n_words = len(text), raw.sum(), len(words)
    upper, lower, digits = raw[65:91].sum(), raw[97:123].sum(), raw[48:58].sum()
    seen = Counter(words)
    pairs = max(1, n_words - 1)
    same = sum(a == b for a, b in zip(words, words[1:]))
    lines = [x for x in text.split("\n") if x]
    marked = sum(not w[-1].isalnum() and w[-1] not in ".,;:?" for w in words)
    return [
        n, n_words, sum(map(len, words)) / n_words, upper / max(1, upper + lower), digits / size,
        raw[_MARKS].sum() / size, raw[_SYMBOLS].sum() / size, raw[124] / n_words, raw[33] / n_words,
        raw[128:].sum() / size, (raw[32] + raw[9] + raw[10]) / size, len(seen) / n_words,
        max(seen.values()) / n_words, same / pairs, len(set(zip(words, words[1:]))) / pairs, len(lines),
        n / max(1, len(lines)), 1 - len(set(lines)) / max(1, len(lines)), marked / n_words,
        sum(len(w) < 3 for w in words) / n_words,
    ]


def _measure(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                values = np.array([statistics(t) for t in part.column("text").to_pylist()], float)
                yield record(schema, *part.columns[:-1], *values.reshape(-1, len(STATISTICS)).T)

    return run


def measure(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """`keep` columns and one double per statistic of each row's whole text."""
    from pyspark.sql.pandas.types import to_arrow_schema

    clash = {"text", *STATISTICS} & set(keep)
    if clash:
        raise ValueError(f"`keep` names statistics: {sorted(clash)}")
    rows = docs.select(*keep, F.col(text).alias("text"))
    schema = pa.schema([*to_arrow_schema(rows.select(*keep).schema), *((s, pa.float64()) for s in STATISTICS)])
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[: len(keep)])
    return map_batches(rows, _measure(schema), f"{ddl}, " + ", ".join(f"{s} double" for s in STATISTICS))


#: One comparison: statistic, bound, and whether values up to the bound (or above it) hold.
Test = tuple[int, float, bool]


@dataclass
class RuleModel:
    bias: float = 0.0
    rules: list[tuple[tuple[Test, ...], float]] = field(default_factory=list)

    def column(self) -> Column:
        """The score as one expression over the statistic columns."""
        logit = F.lit(self.bias)
        for tests, weight in self.rules:
            held = F.lit(True)
            for j, bound, below in tests:
                value = F.col(STATISTICS[j])
                held = held & (value <= bound if below else value > bound)
            logit = logit + F.when(held, F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-logit))


def _paths(x, cells, edges, slope, curve, rng) -> tuple[list[tuple[Test, ...]], np.ndarray]:
    """One tree on half of the rows and statistics: all its paths, and its step for every row."""
    rows = np.flatnonzero(rng.random(len(x)) < 0.5)
    used = np.flatnonzero(rng.random(x.shape[1]) < 0.5)
    paths: list[tuple[Test, ...]] = []
    step = np.zeros(len(x))

    def grow(own, every, tests):
        g, h = slope[own], curve[own]
        if tests:
            paths.append(tests)
        step[every] = -g.sum() / (h.sum() + 1)
        if len(tests) == DEPTH or len(own) < 20:
            return
        best, score = None, 1e-3
        whole = g.sum() ** 2 / (h.sum() + 1)
        for j in used:
            if not len(edges[j]):
                continue
            c = cells[own, j]
            n = len(edges[j]) + 1
            gs = np.cumsum(np.bincount(c, g, n))[:-1]
            hs = np.cumsum(np.bincount(c, h, n))[:-1]
            ns = np.cumsum(np.bincount(c, minlength=n))[:-1]
            gain = gs**2 / (hs + 1) + (g.sum() - gs) ** 2 / (h.sum() - hs + 1) - whole
            gain[(ns < 5) | (len(own) - ns < 5)] = 0
            k = int(gain.argmax())
            if gain[k] > score:
                best, score = (j, k), gain[k]
        if best:
            j, k = best
            for below in (True, False):
                side = (cells[own, j] <= k) == below
                all_side = (cells[every, j] <= k) == below
                grow(own[side], every[all_side], (*tests, (int(j), float(edges[j][k]), below)))

    grow(rows, np.arange(len(x)), ())
    return paths, step


def _holds(x: np.ndarray, tests: tuple[Test, ...]) -> np.ndarray:
    held = np.ones(len(x), bool)
    for j, bound, below in tests:
        held &= (x[:, j] <= bound) == below
    return held


def _lasso(z: np.ndarray, y: np.ndarray, strength: float, rounds: int = 400) -> tuple[float, np.ndarray]:
    """Logistic regression with an L1 penalty by accelerated proximal gradient steps."""
    n, m = z.shape
    y = y.astype(np.float32)
    rate = np.float32(4 * n / (np.linalg.eigvalsh(z.T @ z)[-1] + n))
    w, b = np.zeros(m, np.float32), np.float32(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    v, c, t, strength = w.copy(), b, 1.0, np.float32(strength)
    for _ in range(rounds):
        error = 1 / (1 + np.exp(-np.clip(z @ v + c, -30, 30))) - y
        moved = v - rate * (z.T @ error) / n
        new = np.sign(moved) * np.maximum(np.abs(moved) - rate * strength, 0)
        shift = c - rate * error.mean()
        later = (1 + (1 + 4 * t * t) ** 0.5) / 2
        push = np.float32((t - 1) / later)
        v, c = new + push * (new - w), shift + push * (shift - b)
        w, b, t = new, shift, later
    return b, w


def fit(x: np.ndarray, y: np.ndarray, seed: int = 7) -> RuleModel:
    """Rules and weights from statistics and 0/1 labels (or their means)."""
    if not len(y):
        return RuleModel()
    mean = (y.sum() + 1) / (len(y) + 2)
    if len(np.unique(y >= 0.5)) < 2:
        return RuleModel(float(np.log(mean / (1 - mean))))
    rng = np.random.default_rng(seed)
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    edges = [e[e < c.max()] for e, c in zip(edges, x.T)]
    cells = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], 1)
    logit, found = np.full(len(y), np.log(mean / (1 - mean))), {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-logit))
        paths, step = _paths(x, cells, edges, p - y, p * (1 - p), rng)
        logit += RATE * np.clip(step, -4, 4)
        for tests in paths:
            found.setdefault(_holds(x, tests).tobytes(), tests)  # rules that agree on every row count once
    rules = list(found.values())
    z = np.stack([_holds(x, r) for r in rules], 1).astype(np.float32)
    check = rng.random(len(y)) < 0.2
    best = (np.inf, 1e-3)
    for strength in (1e-2, 3e-3, 1e-3, 3e-4, 1e-4):
        b, w = _lasso(z[~check], y[~check], strength, 120)
        p = np.clip(1 / (1 + np.exp(-np.clip(z[check] @ w + b, -30, 30))), 1e-6, 1 - 1e-6)
        loss = -np.mean(y[check] * np.log(p) + (1 - y[check]) * np.log(1 - p)) if check.any() else strength
        if loss < best[0] * 0.99:
            best = (loss, strength)
    b, w = _lasso(z, y, best[1])
    return RuleModel(float(b), [(r, float(v)) for r, v in zip(rules, w) if abs(v) > 1e-6])


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", most: int = MOST_LABELLED) -> RuleModel:
    """Fit on at most `most` labelled documents; `labels` holds (key, label), held-out rows removed."""
    named = labels.select(F.col(key).alias("key"), F.col("label").cast("double").alias("label")).dropna()
    sample = named.groupBy("key").agg(F.avg("label").alias("label")).orderBy(F.xxhash64("key"), "key").limit(most)
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    # The sample has at most `most` rows of two numbers, so it may be broadcast.
    rows = measure(texts.join(F.broadcast(sample), "key"), ["key", "label"]).toPandas()
    rows = rows.sort_values(["key", *STATISTICS])
    return fit(rows[list(STATISTICS)].to_numpy(float), rows["label"].to_numpy(float))


def score(docs: DataFrame, model: RuleModel, keep: list[str], text: str = "text") -> DataFrame:
    """`keep` columns and `score`, the probability of label 1."""
    return measure(docs, keep, text).select(*keep, model.column().alias("score"))
