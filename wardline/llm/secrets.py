"""Secrets in texts: fixed patterns, and random-looking strings by two character Markov models.

All of it is column functions. Base kinds follow fixed patterns. The added kind `markov` takes
long tokens with a digit that touch no base span, and compares how likely their characters follow
each other in random strings and in ordinary identifiers (log-likelihood ratio per character).
Both models are first-order, counted over all documents and backed off to single characters: strings that the base
patterns label as secret values train the one, other long tokens made of words and numbers (by the
mean length of their pieces) the other; tokens that are neither, among them secrets no pattern
labels, train none. Nor does a fifth of the strings, by their hash: these pick the ratio from which
a token counts as random.

Null text counts as empty and has no spans. Repeated rows and null ids give a row each. Without
any sample both models are uniform, the ratio is 0 and nothing is added. Of other columns none
is read. Offsets count code points; ends are exclusive.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed patterns of the base kinds. A run of 24 or more hex digits is matched as such: shorter
# runs would be dropped, and a run is never matched in part. The same holds for access keys.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "markov")
ASSIGN_WORDS = ("passw", "secret", "token", "apikey", "api_key")
LEAST_VALUE = 6

TOKEN = r"[A-Za-z0-9+/_=-]{16,}"
#: The same tokens with a digit somewhere; the first look-behind keeps long tokens linear.
TOKEN_WITH_DIGIT = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])" + TOKEN
#: A word, capitalised or not, or a number; in an ordinary token they have so many characters on average.
PIECE, PIECE_CHARS = "[A-Z]?[a-z]+|[A-Z]+|[0-9]+", 4
#: Up to 1025 characters, of which all but the last are passed over.
WINDOW = "(?=(.{2,1025})).{1,1024}"
#: Nats per character from which a token counts as random where no held-out string says otherwise.
LEAST_RATIO = 0.3
#: Strings with this remainder of crc32 are held out; thresholds are tried in steps up to a limit.
FOLDS, HELD_OUT = 5, 0
STEP, STEPS = 0.05, 60
#: One share of ordinary tokens taken for random weighs like so many of random strings missed.
FALSE_WEIGHT = 10
_CODES = 128
#: How many observations the single-character model counts as.
_BACK = 32
_BLOCK = 64


def _let(body, **values: Column) -> Column:
    """`body` of a struct of values. As a lambda's variable each value is worked out once; columns
    of an earlier step may be put in place of their names, and then run again for every element."""
    held = F.struct(*[v.alias(k) for k, v in values.items()])
    return F.get(F.transform(F.array(held), body), F.lit(0))


def _blocks(values: Column) -> Column:
    """The array in slices of `_BLOCK`, none for an empty one."""
    return _let(
        lambda v: F.when(
            F.size(v["x"]) > 0,
            F.transform(
                F.sequence(F.lit(0), F.floor((F.size(v["x"]) - 1) / _BLOCK).cast("int")),
                lambda i: F.slice(v["x"], i * _BLOCK + 1, F.lit(_BLOCK)),
            ),
        ),
        x=values,
    )


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda s, x: s + x)


def _found(df: DataFrame, name: str, pattern: str, when: Column | None = None) -> DataFrame:
    """Adds `name`: array<struct<start, end, text>> of leftmost non-overlapping matches.

    What lies between matches and the matches themselves alternate, so their lengths add up to
    positions. Sums are taken over blocks, which keeps texts with very many matches cheap.
    """
    hit = F.col("text").rlike(pattern) if when is None else when & F.col("text").rlike(pattern)

    def placed(v: Column) -> Column:
        """v: matches m, lengths p of what lies before each, lengths l of both, sums o before each block."""

        def span(m: Column, i: Column) -> Column:
            block = F.floor(i / _BLOCK).cast("int")
            within = F.slice(v["l"], block * _BLOCK + 1, i % _BLOCK)
            start = v["o"][block] + v["p"][i] + _total(within)
            return F.struct(start.cast("int").alias("start"), (start + F.length(m)).cast("int").alias("end"), m.alias("text"))

        return F.transform(v["m"], span)

    def summed(v: Column) -> Column:
        sums = F.transform(v["s"], _total)
        before = _let(lambda w: F.transform(w["s"], lambda x, i: _total(F.slice(w["s"], 1, i))), s=sums)
        return _let(placed, m=v["m"], p=v["p"], l=v["l"], o=before)

    def measured(v: Column) -> Column:
        lengths = F.transform(v["m"], lambda m, i: F.length(m) + v["p"][i])
        return _let(lambda w: _let(summed, m=w["m"], p=w["p"], l=w["l"], s=_blocks(w["l"])), m=v["m"], p=v["p"], l=lengths)

    spans = _let(
        measured,
        m=F.regexp_extract_all("text", F.lit(pattern), F.lit(0)),
        p=F.transform(F.split("text", pattern, -1), F.length),
    )
    empty = F.expr("cast(array() as array<struct<start: int, end: int, text: string>>)")
    return df.withColumn(name, F.coalesce(F.when(hit, spans), empty))


def _may_assign() -> Column:
    low = F.lower("text")
    hit = F.lit(False)
    for word in ASSIGN_WORDS:
        hit = hit | low.contains(word)
    return hit


def _values() -> Column:
    """Strings of the text that the base patterns label as secret values."""
    assigned = F.when(_may_assign(), F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)))
    return F.concat(
        F.filter(F.coalesce(assigned, F.array().cast("array<string>")), lambda v: F.length(v) >= LEAST_VALUE),
        F.regexp_extract_all("text", F.lit(ACCESS), F.lit(0)),
        F.regexp_extract_all("text", F.lit(HEX), F.lit(0)),
    )


def _strings(docs: DataFrame, text: str) -> DataFrame:
    """(random, t, held_out): secret values as labelled by the base patterns, and ordinary tokens."""
    rows = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("values", _values())
    # Assignments are taken out first, so their values need not be looked for among the tokens.
    rest = F.when(_may_assign(), F.regexp_replace("text", ASSIGN, " ")).otherwise(F.col("text"))

    def worded(t: Column) -> Column:
        return F.regexp_count(t, F.lit(PIECE)) * PIECE_CHARS <= F.regexp_count(t, F.lit("[A-Za-z0-9]"))

    ordinary = F.filter(
        F.regexp_extract_all(rest, F.lit(TOKEN), F.lit(0)), lambda t: ~t.rlike(f"{ACCESS}|{HEX}") & worded(t)
    )
    labelled = F.concat(
        F.transform("values", lambda v: F.struct(F.lit(1).alias("random"), v.alias("t"))),
        F.transform(ordinary, lambda v: F.struct(F.lit(0).alias("random"), v.alias("t"))),
    )
    strings = rows.select(F.explode(labelled).alias("x")).select("x.random", "x.t").filter(F.length("t") > 1)
    return strings.withColumn("held_out", F.crc32(F.encode("t", "UTF-8")) % FOLDS == HELD_OUT)


def train(docs: DataFrame, text: str = "text") -> list[float]:
    """Log-likelihood ratios of character pairs, at 128 * first + second, over all documents.

    Held-out strings are left out.
    """
    tokens = _strings(docs, text).filter("NOT held_out")
    # Windows share a character with the next one, so each pair lies in one of them and no array gets long.
    windows = tokens.select("random", F.explode(F.regexp_extract_all("t", F.lit(WINDOW), F.lit(1))).alias("t"))
    pairs = windows.select("random", F.explode(F.regexp_extract_all("t", F.lit("(?=(..))"), F.lit(1))).alias("pair"))
    # At most 2 * 128 * 128 rows, whatever the input.
    counts = pairs.groupBy("random", "pair").count().collect()
    model = [[[0] * _CODES for _ in range(_CODES)] for _ in range(2)]
    for r in counts:
        model[r["random"]][ord(r["pair"][0])][ord(r["pair"][1])] = r["count"]
    kinds = sum(c.isascii() and (c.isalnum() or c in "+/_=-.") for c in map(chr, range(_CODES)))

    logs = []
    for pair in model:
        after = [sum(row[b] for row in pair) for b in range(_CODES)]
        alone = [(n + 1) / (sum(after) + kinds) for n in after]
        logs.append(
            [
                [math.log((n + _BACK * alone[b]) / (sum(row) + _BACK)) for b, n in enumerate(row)]
                for row in pair
            ]
        )
    ordinary_log, random_log = logs
    return [random_log[a][b] - ordinary_log[a][b] for a in range(_CODES) for b in range(_CODES)]


def _table(ratios: list[float]) -> Column:
    return F.split(F.lit(",".join(f"{x:.6g}" for x in ratios)), ",").cast("array<double>")


def _score(token: Column, table: Column) -> Column:
    """Nats per character pair; the token has two characters or more, of ASCII. Characters are taken
    from an array: a substring's place is looked for from the start, which long tokens cannot bear."""

    def summed(v: Column) -> Column:
        places = F.sequence(F.lit(1), F.size(v["codes"]) - 1)
        total = F.aggregate(places, F.lit(0.0), lambda s, i: s + table[v["codes"][i - 1] * _CODES + v["codes"][i]])
        return total / (F.size(v["codes"]) - 1)

    return _let(summed, codes=F.transform(F.split(token, ""), F.ascii))


@dataclass(frozen=True)
class Threshold:
    """`ratio` nats per character, and what it makes of the held-out strings (shares; None: no string)."""

    ratio: float
    recall: float | None = None
    false_share: float | None = None
    n_random: int = 0
    n_ordinary: int = 0


def threshold(docs: DataFrame, ratios: list[float], text: str = "text") -> Threshold:
    """The ratio that does best on held-out strings a scan would judge: recall - 10 * false share.

    Of equally good ratios the middle one is taken, away from both kinds; only ratios above 0 are
    tried. Strings count as often as they occur.
    """
    judged = _strings(docs, text).filter("held_out").filter(F.col("t").rlike(f"^(?=.*[0-9]){TOKEN}$"))
    score = _let(lambda v: _score(v["t"], v["table"]), t=F.col("t"), table=_table(ratios))
    step = F.greatest(F.lit(0), F.least(F.lit(STEPS), F.floor(score / STEP))).alias("step")
    # At most 2 * (STEPS + 1) rows.
    counts = judged.select("random", step).groupBy("random", "step").count().collect()
    seen = [[0] * (STEPS + 1) for _ in range(2)]
    for r in counts:
        seen[r["random"]][r["step"]] += r["count"]
    n_ordinary, n_random = map(sum, seen)
    if not n_ordinary or not n_random:
        return Threshold(LEAST_RATIO, n_random=n_random, n_ordinary=n_ordinary)
    tried = []
    for i in range(1, STEPS + 1):
        recall, false = sum(seen[1][i:]) / n_random, sum(seen[0][i:]) / n_ordinary
        tried.append((recall - FALSE_WEIGHT * false, Threshold(i * STEP, recall, false, n_random, n_ordinary)))
    best = max(worth for worth, _ in tried)
    equal = [t for worth, t in tried if worth == best]
    return equal[len(equal) // 2]


def scan(
    docs: DataFrame, ratios: list[float], key: str = "doc_id", text: str = "text", least: float = LEAST_RATIO
) -> DataFrame:
    """(key, spans) with spans array<struct<start, kind_no, end, kind>> in order, one row per row.

    Tokens of `least` nats per character or more are added.
    """
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = _found(rows, "assign", ASSIGN, _may_assign())
    rows = _found(rows, "access", ACCESS)
    rows = _found(rows, "hex", HEX)
    rows = _found(rows, "token", TOKEN_WITH_DIGIT)
    assign = F.filter("assign", lambda m: F.length(F.regexp_extract(m["text"], ASSIGN, 2)) >= LEAST_VALUE)

    def spans(matches: Column, number: int) -> Column:
        return F.transform(
            matches,
            lambda m: F.struct(
                m["start"].alias("start"), F.lit(number).alias("kind_no"), m["end"].alias("end"),
                F.lit(KINDS[number]).alias("kind"),
            ),
        )

    rows = rows.withColumn("base", F.concat(spans(assign, 0), spans(F.col("access"), 1), spans(F.col("hex"), 2)))
    rows = rows.withColumn("table", _table(ratios))

    def added(v: Column) -> Column:
        # Hex digits and access keys are token characters, so a token touches a span of theirs if
        # and only if it holds one. Spans of assignments are looked up by blocks of neighbours.
        def meets(a: Column, t: Column, last: Column | None = None) -> Column:
            return (a["start"] < t["end"]) & (t["start"] < (a if last is None else last)["end"])

        def touched(t: Column) -> Column:
            inside = lambda b: meets(b[0], t, F.element_at(b, -1)) & F.exists(b, lambda a: meets(a, t))
            return t["text"].rlike(f"{ACCESS}|{HEX}") | F.coalesce(F.exists(v["blocks"], inside), F.lit(False))

        return F.filter(v["token"], lambda t: ~touched(t) & (_score(t["text"], v["table"]) >= least))

    free = _let(added, token=F.col("token"), blocks=_blocks(assign), table=F.col("table"))
    every = F.sort_array(F.concat("base", spans(free, 3)))
    return rows.select(F.col("key").alias(key), every.alias("spans"))


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
