"""Language shares of each document: a mixture of n-gram models, fitted by EM, kept sparse.

Letter trigrams (lower case, words padded with a space) are counted per language over all
training documents, hashed into `BUCKETS` cells. A document's n-grams are taken as drawn from a
mixture of languages. Its language set grows from the single best language: the language with the
steepest likelihood gain is tried, EM estimates the shares, and it stays if the likelihood grows
by more than the penalty. Predicted is the language with the largest share.

Null text and text without a letter give `und`, score 0 and no shares, as does every text when
nothing could be learned. Ties go to the first language by name. Repeated rows and null ids give
a row each. Whole texts are read; other columns are not.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, record, slices

BUCKETS = 1 << 15
UNKNOWN = "und"
#: What a further language must add to the log-likelihood, times the log of the n-grams.
PENALTY = 4.0
#: Neighbouring trigrams overlap, so log-likelihoods count as this many times too large.
OVERLAP = 3.0
_ALPHA, _ROUNDS = 0.2, 15
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def ngrams(text: str) -> np.ndarray:
    """Cells of the letter trigrams of a whole text; empty without letters."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[codes]
    codes = np.where(letter, codes, 32)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    codes = np.concatenate(([32], codes[keep], [32])).astype(np.uint64)
    if not letter.any():
        return np.empty(0, np.int64)
    h = codes[:-2] * np.uint64(0x9E3779B97F4A7C15) + codes[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)
    h = (h + codes[2:] * np.uint64(0x165667B19E3779F9)) * np.uint64(0xD6E8FEB86659FD93)
    return (h >> np.uint64(49)).astype(np.int64)[codes[1:-1] != 32]


def _count(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, "text"):
                for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
                    cells = ngrams(text)
                    if len(cells):
                        held = counts.setdefault(lang, np.zeros(BUCKETS, np.int64))
                        held += np.bincount(cells, minlength=BUCKETS)
        for lang, held in counts.items():
            cells = np.flatnonzero(held)
            yield record(schema, [lang] * len(cells), cells, held[cells])

    return run


class Model:
    """n-gram probabilities: languages in order of name, one column each."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        self.p = (counts + _ALPHA) / (counts.sum(0) + _ALPHA * BUCKETS)

    def shares(self, text: str | None) -> tuple[dict[str, float], float]:
        """(share by language of the chosen set, certainty that its best one is right)."""
        cells = ngrams(text or "")
        if not len(cells) or not self.languages:
            return {}, 0.0
        if len(cells) > BUCKETS // 4:
            every = np.bincount(cells, minlength=BUCKETS)
            unique = np.flatnonzero(every)
            n = every[unique].astype(float)
        else:
            unique, n = np.unique(cells, return_counts=True)
            n = n.astype(float)
        p, total = self.p[unique], n.sum()
        alone = n @ np.log(p)
        best = int(alone.argmax())
        chosen, weight, fit = [best], np.ones(1), alone[best]
        while len(chosen) < len(self.languages):
            gain = (n / (p[:, chosen] @ weight)) @ p / total
            gain[chosen] = 0
            new = int(gain.argmax())
            if gain[new] <= 1:
                break
            trial, w = [*chosen, new], np.append(weight * 0.7, 0.3)
            for _ in range(_ROUNDS):
                w = w * ((n / (p[:, trial] @ w)) @ p[:, trial]) / total
            value = n @ np.log(p[:, trial] @ w)
            if value - fit <= PENALTY * np.log(total + 1):
                break
            chosen, weight, fit = trial, w, value
        odds = np.exp((alone - alone[best]) / OVERLAP)
        return {self.languages[c]: float(w) for c, w in zip(chosen, weight)}, float(1 / odds.sum())


def train(docs: DataFrame, training: Column, text: str = "text", lang: str = "lang") -> Model:
    """Counts over all rows where `training` holds and language and text are not null."""
    rows = docs.filter(training).select(F.col(lang).alias("lang"), F.col(text).alias("text")).dropna()
    schema = pa.schema([("lang", pa.string()), ("cell", pa.int64()), ("n", pa.int64())])
    cells = map_batches(rows, _count(schema), "lang string, cell long, n long")
    # At most languages x BUCKETS rows, whatever the input.
    found = cells.groupBy("lang", "cell").agg(F.sum("n").alias("n")).toArrow()
    names = found["lang"].to_pylist()
    languages = sorted(set(names))
    counts = np.zeros((BUCKETS, len(languages)))
    at = {name: i for i, name in enumerate(languages)}
    column = np.array([at[name] for name in names], np.int64)
    counts[found["cell"].to_numpy(), column] = found["n"].to_numpy()
    return Model(languages, counts)


def _predict(model, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model.value
        for batch in batches:
            for part in slices(batch, "text"):
                names, shares, scores, every = [], [], [], []
                for text in part.column("text").to_pylist():
                    held, sure = known.shares(text)
                    top = min(held, key=lambda k: (-held[k], k), default=UNKNOWN)
                    names.append(top)
                    shares.append(held.get(top, 0.0))
                    scores.append(min(1.0, held.get(top, 0.0) * sure))
                    every.append(list(held.items()))
                yield record(schema, *part.columns[:-1], names, shares, scores, every)

    return run


def predict(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """`keep` columns with lang_pred, share (of that language), score and shares by language."""
    from pyspark.sql.pandas.types import to_arrow_schema

    if "text" in keep:
        raise ValueError("`keep` names key columns; the text is read anyway")
    rows = docs.select(*keep, F.col(text).alias("text"))
    kept = to_arrow_schema(rows.select(*keep).schema)
    schema = pa.schema(
        [*kept, ("lang_pred", pa.string()), ("share", pa.float64()), ("score", pa.float64()), ("shares", pa.map_(pa.string(), pa.float64()))]
    )
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[: len(keep)])
    ddl += ", lang_pred string, share double, score double, shares map<string, double>"
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return map_batches(rows, _predict(shared, schema), ddl)


def _accept(model, least: float, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model.value
        for batch in batches:
            for part in slices(batch, "text"):
                texts = part.column("text").to_pylist()
                keep = [max(known.shares(t)[0].values(), default=0.0) >= least for t in texts]
                yield record(schema, *part.filter(pa.array(keep, pa.bool_())).columns)

    return run


def accepted(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """Rows of `docs`, all columns, whose text has a known language with at least this share.

    Null text, text without letters, and mixtures in which no language reaches the share go.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    shared = docs.sparkSession.sparkContext.broadcast(model)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return map_batches(docs, _accept(shared, least, to_arrow_schema(docs.schema)), ddl)
