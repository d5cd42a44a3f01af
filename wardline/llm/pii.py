"""Personal data by weak supervision: labelers vote, EM weighs them, a span classifier decides.

Base kinds (email, ip, card, phone) follow fixed patterns and always stay. Further candidates
(numbers written like local phone numbers or national ids, names after a title or led by a given
name, bank accounts, street addresses) are judged: regex, gazetteer and context labelers vote yes,
no or nothing on every candidate and base span. Expectation-maximisation over the counts of all
vote patterns of the corpus estimates per kind how often each labeler votes which way on true and
false spans. Its posteriors are the soft labels of a logistic span classifier over votes and shape.
What that holds for true and false is summed over the corpus by the words beside the spans, and the
log-odds of these words complete the classifier. Candidates it gives 0.5 or more become spans.

Counts are bounded by kinds x votes x shapes and kinds x cells, never by the corpus. Null text counts
as empty. Repeated rows and null ids give a row each; an empty table gives none. Columns other
than key and text are not read. Offsets count code points; ends are exclusive.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, record, slices

KINDS = ("email", "ip", "card", "phone", "contact", "national", "person", "account", "address")
BASE = 4

# Fixed patterns of the base kinds (the e-mail pattern is matched around each @, see emails()).
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Candidates of the added kinds.
_CONTACT = re.compile(r"(?<![0-9A-Za-z+.-])\(?[0-9]{2,5}\)?[ .-][0-9]{3,4}[ .-][0-9]{3,4}(?![0-9A-Za-z.-])")
_NATIONAL = re.compile(r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])")
TITLES = ("Mr. ", "Mrs. ", "Ms. ", "Dr. ", "Prof. ", "Herr ", "Frau ", "Madame ", "Monsieur ")
_PERSON = re.compile("(?:" + "|".join(map(re.escape, TITLES)) + r")[A-Z][a-z]+(?: [A-Z][a-z]+)?")
_NAME = re.compile(r"(?<![0-9A-Za-z])([A-Z][a-z]+) [A-Z][a-z]+")
_ACCOUNT = re.compile(r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])")
STREETS = ("Street", "Road", "Avenue", "Lane", "Drive", "Boulevard", "Court", "St", "Rd", "Ave", "Blvd")
STREET_ENDS = ("straße", "strasse", "gasse", "platz", "weg")
_ADDRESS = re.compile(
    r"(?<![0-9A-Za-z])(?:[0-9]{1,5} (?:[A-Z][a-z]{1,20} ){1,3}(?:" + "|".join(STREETS)
    + r")|[0-9]{1,4},? (?:rue|avenue|calle) (?:d\w{1,2} )?[A-Z]\w{1,20}|[A-Z][a-zäöü]{1,20}(?:"
    + "|".join(STREET_ENDS) + r") [0-9]{1,4})(?![0-9A-Za-z])"
)

#: Entries a gazetteer table may have: it goes to every task.
MOST_ENTRIES = 1_000_000


@dataclass(frozen=True)
class Gazetteers:
    """Common domain ends, calling codes, issuer digits of cards, given names, account lengths by country."""

    ending: frozenset = frozenset("com org net edu gov info io de fr es uk eu us ca".split())
    calling: frozenset = frozenset("1 7 20 27 30 31 32 33 34 39 41 43 44 45 46 47 48 49 52 55 61 81 86 91".split())
    issuer: frozenset = frozenset("23456")
    given: frozenset = frozenset("Anna Carlos Claire David Elena Emma Hans James Jean John Julia Karl Laura Luis Maria Marie Michael Paul Peter Pierre Sara Thomas".split())
    account: frozenset = frozenset("AT20 BE16 CH21 DE22 DK18 ES24 FI18 FR27 GB22 IE22 IT27 NL18 NO15 PL28 PT25 SE24".split())

    @classmethod
    def from_table(cls, entries: DataFrame) -> Gazetteers:
        """From rows (list, entry), with lists named as the fields; lists without a row keep their
        entries. Null entries count for nothing. Tables beyond `MOST_ENTRIES` rows are refused."""
        names = list(cls.__dataclass_fields__)
        rows = entries.select("list", "entry").filter(F.col("list").isin(names)).dropna().distinct()
        found = rows.limit(MOST_ENTRIES + 1).collect()
        if len(found) > MOST_ENTRIES:
            raise ValueError(f"gazetteers have more than {MOST_ENTRIES} entries")
        lists: dict[str, set] = {}
        for r in found:
            lists.setdefault(r["list"], set()).add(r["entry"])
        return cls(**{k: frozenset(v) for k, v in lists.items()})


KNOWN = Gazetteers()
# Words that speak for or against personal data when shortly before a span.
FOR = re.compile(r"mail|phone|tel\b|call|fax|mobile|card|visa|ssn|social|contact|reach|address|name|\bip\b|iban|account|konto|lives|resid|wohn", re.I)
AGAINST = re.compile(r"version|page|isbn|issn|license|licence|section|chapter|price|order no|figure|table|port\b|rfc", re.I)
NEAR = 40


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches around each @; no character is looked at more than a few times."""
    free, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in _LOCAL:
            begin -= 1
        m = _DOMAIN.match(text, at + 1) if begin < at else None
        if m:
            yield begin, m.end()
            free = m.end()
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base kinds, in order."""
    out = [(s, 0, e) for s, e in emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if len(m[0]) <= 37 and 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= len(_digits(m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def bank_check(account: str) -> bool:
    """The check digits of an international account number (remainder 1 of 97)."""
    bare = account.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in bare[4:] + bare[:4])) % 97 == 1


def candidates(text: str, base: list[tuple[int, int, int]], known: Gazetteers = KNOWN) -> list[tuple[int, int, int]]:
    """(start, kind, end) of further candidates that touch no base span."""
    found = []
    for kind, pattern in ((5, _NATIONAL), (4, _CONTACT), (7, _ACCOUNT), (8, _ADDRESS)):
        found += [(m.start(), kind, m.end()) for m in pattern.finditer(text)]
    if any(t in text for t in TITLES):
        found += [(m.start(), 6, m.end()) for m in _PERSON.finditer(text)]
    found += [(m.start(), 6, m.end()) for m in _NAME.finditer(text) if m[1] in known.given]
    taken, out = sorted(base), []
    ends = [s[2] for s in taken]
    at = 0
    for span in sorted(found):
        while at < len(taken) and ends[at] <= span[0]:
            at += 1
        if (at == len(taken) or taken[at][0] >= span[2]) and (not out or out[-1][2] <= span[0]):
            out.append(span)
    return out


def votes(text: str, start: int, kind: int, end: int, lists: Gazetteers = KNOWN) -> tuple[int, ...]:
    """1 for, 0 against, 2 no vote: strict shape, gazetteer, words before, variety, free standing."""
    span = text[start:end]
    digits = _digits(span)
    if kind == 0:
        shape = span.rpartition(".")[2].isalpha()
        known = span.rpartition(".")[2].lower() in lists.ending
    elif kind == 1:
        shape = all(p == (p.lstrip("0") or "0") for p in span.split("."))
        known = not span.startswith(("0.", "127.", "255."))
    elif kind == 2:
        shape = len(digits) in (15, 16) and len(set(span) - set("0123456789")) < 2
        known = digits[0] in lists.issuer
    elif kind == 3:
        shape = span.count("(") == span.count(")") < 2
        known = any(digits[:n] in lists.calling for n in (1, 2, 3))
    elif kind == 4:
        shape = len(digits) in (9, 10, 11) and span.count("(") == span.count(")")
        known = not digits.startswith(("00", "1900", "19", "20"))
    elif kind == 5:
        shape = digits[:3] not in ("000", "666") and digits[3:5] != "00" and digits[5:] != "0000"
        known = digits[0] != "9"
    elif kind == 6:
        titled = span.startswith(TITLES)
        words = span.split()[titled:]
        shape = len(words) == 2
        known = any(w in lists.given for w in words) or 2
    elif kind == 7:
        shape = bank_check(span)
        known = f"{span[:2]}{len(span.replace(' ', ''))}" in lists.account
    else:
        shape = not (len(digits) == 4 and digits.startswith(("19", "20")))
        known = any(w in STREETS[:7] or w.endswith(STREET_ENDS) for w in span.split()) or 2
    before = text[max(0, start - NEAR) : start]
    context = 1 if FOR.search(before) else 0 if AGAINST.search(before) else 2
    variety = 2 if kind in (0, 1, 6, 8) else int(len(set(digits)) > 4)
    edges = text[max(0, start - 1) : start] + text[end : end + 1]
    alone = int(not any(c.isalnum() or c in "_/=" for c in edges))
    return int(shape), int(known), context, variety, alone


def shape_bits(text: str, start: int, end: int) -> int:
    span = text[start:end]
    n = len(_digits(span))
    tests = (n >= 9, n == 10, " " in span, "-" in span, "(" in span, any(c.isalpha() for c in span))
    return sum(1 << i for i, t in enumerate(tests) if t)


LABELERS, SHAPES = 5, 6
#: Words beside spans fall into so many cells. Words seen less than about `PRIOR` times say little;
#: one word shifts the log-odds by at most `MOST_SHIFT`.
CELLS, PRIOR, MOST_SHIFT = 1024, 8, 1.0
_BESIDE = 24
_LAST = re.compile(r"(\w+)\W*$")
_NEXT = re.compile(r"\W*(\w+)")


def beside(text: str, start: int, end: int) -> tuple[int, int]:
    """Cells of the word before and the word after a span; numbers are alike, no word is cell 0."""
    cells = []
    for m in (_LAST.search(text[max(0, start - _BESIDE) : start]), _NEXT.match(text[end : end + _BESIDE])):
        word = "" if m is None else "#" if m[1].isdecimal() else m[1].lower()
        cells.append(zlib.crc32(word.encode()) % (CELLS - 1) + 1 if word else 0)
    return cells[0], cells[1]


@dataclass(frozen=True)
class Model:
    """Weights of votes and shape, log-odds by [kind, before or after, cell], and the lists used."""

    weights: np.ndarray
    words: np.ndarray
    known: Gazetteers

    def scores(self, text: str, spans: list[tuple[int, int, int]]) -> np.ndarray:
        kind = np.array([k for _, k, _ in spans])
        vote = np.array([votes(text, *s, self.known) for s in spans])
        shape = np.array([shape_bits(text, s, e) for s, _, e in spans])
        at = np.array([beside(text, s, e) for s, _, e in spans])
        shift = self.words[kind, 0, at[:, 0]] + self.words[kind, 1, at[:, 1]]
        return features(kind, vote, shape) @ self.weights + shift


def _count(schema: pa.Schema, known: Gazetteers):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for part in slices(batch, "text"):
                for text in part.column("text").to_pylist():
                    base = base_spans(text)
                    for start, kind, end in [*base, *candidates(text, base, known)]:
                        seen[kind, *votes(text, start, kind, end, known), shape_bits(text, start, end)] += 1
        if seen:
            yield record(schema, *zip(*((k[0], list(k[1:-1]), k[-1], n) for k, n in seen.items())))

    return run


#: No labeler votes against more than this share of the true spans of a kind. Without it, what
#: most labelers let pass and one tells apart would be one class.
MOST_AGAINST = 0.2


def reliabilities(kind: np.ndarray, vote: np.ndarray, n: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Posterior that each pattern is true, by EM per kind; votes are independent given truth."""
    true = np.zeros(len(n))
    for k in np.unique(kind):
        rows = kind == k
        v, w = vote[rows], n[rows].astype(float)
        p = np.clip(((v == 1).sum(1) + 1) / ((v != 2).sum(1) + 2), 0.05, 0.95)
        for _ in range(rounds):
            prior = (w @ p + 1) / (w.sum() + 2)
            log = np.tile(np.log([prior, 1 - prior]), (len(w), 1))
            for j in range(v.shape[1]):
                for c, share in enumerate((p, 1 - p)):
                    # Prior counts hold labelers to be right more often than wrong.
                    held = np.array([w @ (share * (v[:, j] == a)) for a in range(3)])
                    held += [1, 3, 1] if c == 0 else [3, 1, 1]
                    if c == 0:
                        held[0] = min(held[0], MOST_AGAINST / (1 - MOST_AGAINST) * (held[1] + held[2]))
                    log[:, c] += np.log(held[v[:, j]] / held.sum())
            new = 1 / (1 + np.exp(np.clip(log[:, 1] - log[:, 0], -50, 50)))
            if np.abs(new - p).max() < 1e-6:
                break
            p = new
        true[rows] = p
    return true


def features(kind: np.ndarray, vote: np.ndarray, shape: np.ndarray) -> np.ndarray:
    columns = [np.ones(len(kind))]
    columns += [kind == k for k in range(len(KINDS))]
    columns += [vote[:, j] == a for j in range(LABELERS) for a in (0, 1)]
    columns += [(shape >> i) & 1 for i in range(SHAPES)]
    return np.stack([np.asarray(c, float) for c in columns], 1)


#: Beliefs are summed as whole numbers of this part, so that sums do not depend on their order.
_PART = 1024


def _believed(schema: pa.Schema, model: Model):
    """Per kind, side and cell what the model holds for true, and all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        true, all_ = np.zeros((2, *model.words.shape), np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                for text in part.column("text").to_pylist():
                    spans = candidates(text, base_spans(text), model.known)
                    if spans:
                        p = 1 / (1 + np.exp(-np.clip(model.scores(text, spans), -30, 30)))
                        for (start, kind, end), share in zip(spans, np.rint(p * _PART).astype(int)):
                            for side, cell in enumerate(beside(text, start, end)):
                                true[kind, side, cell] += share
                                all_[kind, side, cell] += _PART
        at = np.flatnonzero(all_)
        if len(at):
            yield record(schema, at, true.ravel()[at], all_.ravel()[at])

    return run


def _word_odds(rows: DataFrame, model: Model) -> np.ndarray:
    """How far a word beside a span moves its log-odds from those of its kind."""
    schema = pa.schema([("at", pa.int64()), ("t", pa.int64()), ("n", pa.int64())])
    sums = map_batches(rows, _believed(schema, model), "at long, t long, n long")
    # At most kinds x 2 x CELLS rows, whatever the input.
    true, all_ = np.zeros((2, *model.words.shape))
    for r in sums.groupBy("at").agg(F.sum("t").alias("t"), F.sum("n").alias("n")).collect():
        true.flat[r["at"]], all_.flat[r["at"]] = r["t"] / _PART, r["n"] / _PART
    share = (true.sum(2, keepdims=True) + 1) / (all_.sum(2, keepdims=True) + 2)
    here = (true + PRIOR * share) / (all_ + PRIOR)
    logit = lambda p: np.log(p / (1 - p))
    return np.clip(logit(here) - logit(share), -MOST_SHIFT, MOST_SHIFT)


def train(docs: DataFrame, text: str = "text", known: Gazetteers = KNOWN) -> Model | None:
    """The span classifier from all documents; None where there is no candidate."""
    schema = pa.schema([("kind", pa.int32()), ("votes", pa.list_(pa.int32())), ("shape", pa.int32()), ("n", pa.int64())])
    rows = docs.select(F.col(text).alias("text"))
    counts = map_batches(rows, _count(schema, known), "kind int, votes array<int>, shape int, n long")
    # At most kinds x votes x shapes rows, whatever the input.
    found = counts.groupBy("kind", "votes", "shape").agg(F.sum("n").alias("n")).collect()
    if not found:
        return None
    found.sort(key=lambda r: (r["kind"], r["votes"], r["shape"]))
    kind = np.array([r["kind"] for r in found])
    vote = np.array([r["votes"] for r in found])
    n = np.array([r["n"] for r in found])
    true = reliabilities(kind, vote, n)
    x = features(kind, vote, np.array([r["shape"] for r in found]))
    # Newton steps with a light ridge; each pattern counts as often as it occurs.
    weights, share = np.zeros(x.shape[1]), n / n.sum()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (share * (p - true)) + 1e-4 * weights
        curve = (x * (share * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(len(weights))
        step = np.linalg.solve(curve, slope)
        weights = weights - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    plain = Model(weights, np.zeros((len(KINDS), 2, CELLS)), known)
    return Model(weights, _word_odds(rows, plain), known)


def _scan(model: Model | None, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                out = []
                for text in part.column("text").to_pylist():
                    spans = base_spans(text)
                    more = candidates(text, spans, model.known) if model else []
                    if more:
                        keep = model.scores(text, more) >= 0
                        spans = sorted([*spans, *(s for s, yes in zip(more, keep) if yes)])
                    out.append([{"start": s, "kind_no": k, "end": e, "kind": KINDS[k]} for s, k, e in spans])
                yield record(schema, part.column(0), out)

    return run


def scan(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, spans) with spans array<struct<start, kind_no, end, kind>> in order, one row per row."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = docs.schema[key].dataType
    span = pa.struct([("start", pa.int32()), ("kind_no", pa.int32()), ("end", pa.int32()), ("kind", pa.string())])
    schema = pa.schema([("key", to_arrow_type(kind)), ("spans", pa.list_(span))])
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    ddl = f"key {kind.simpleString()}, spans array<struct<start: int, kind_no: int, end: int, kind: string>>"
    return map_batches(rows, _scan(model, schema), ddl).withColumnRenamed("key", key)
