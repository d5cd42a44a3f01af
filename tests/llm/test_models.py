"""Language shares and rule ensemble: recovery of planted structure, held-out accuracy, edges."""

import random

import numpy as np
import pytest
from conftest import TESTDATA
from fixtures import awkward, documents
from pyspark.sql import functions as F

from wardline.llm import langid, rules
from wardline.llm.common import held_out, table
from wardline.llm.queries import llm_queries


@pytest.fixture(scope="module")
def languages(spark):
    docs = table(spark, TESTDATA, "documents")
    return langid.train(docs, ~held_out(F.col("doc_id")))


def test_held_out_languages(spark):
    docs = table(spark, TESTDATA, "documents").select("doc_id", "lang")
    got = llm_queries()["op8_language_shares"](spark, TESTDATA).filter("held_out").join(docs, "doc_id")
    assert got.filter("lang = lang_pred").count() >= 0.97 * got.count()
    assert got.filter("score < 0 or score > 1").count() == 0


def test_mixture_has_its_languages(spark, languages):
    docs = table(spark, TESTDATA, "documents").filter("n_chars > 2000")
    a, b = (docs.filter(F.col("lang") == x).orderBy("doc_id").first().text for x in ("en", "de"))
    shares, _ = languages.shares(a[:1500] + " " + b[:500])
    assert set(shares) == {"en", "de"} and 0.65 < shares["en"] < 0.85
    assert set(languages.shares(a)[0]) == {"en"}


def test_language_edges(spark, languages):
    texts = awkward()
    got = {r.doc_id: r for r in langid.predict(documents(spark, texts), languages, ["doc_id"]).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        blank = not any(c.isalpha() for c in t or "")
        assert (got[i].lang_pred == "und") == blank
        assert not blank or (got[i].score == 0 and got[i].shares == {})
    kept = langid.accepted(documents(spark, texts), languages)
    assert kept.columns == documents(spark, []).columns
    assert {r.doc_id for r in kept.collect()} == {i for i in got if got[i].lang_pred != "und" and got[i].share >= 0.5}


def test_nothing_to_learn_from(spark):
    docs = documents(spark, ["some text"])
    model = langid.train(docs.filter("false"), F.lit(True))
    assert [r.lang_pred for r in langid.predict(docs, model, ["doc_id"]).collect()] == ["und"]
    none = rules.train(docs, docs.select("doc_id", F.lit(None).cast("int").alias("label")))
    assert rules.score(docs, none, ["doc_id"]).first().score == 0.5
    one = rules.train(docs, docs.select("doc_id", F.lit(1).alias("label")))
    assert rules.score(docs, one, ["doc_id"]).first().score > 0.5


def test_held_out_quality(spark):
    labels = table(spark, TESTDATA, "labels").select("doc_id", "quality")
    got = llm_queries()["op2_rule_ensemble"](spark, TESTDATA)
    assert got.count() == table(spark, TESTDATA, "documents").count()
    seen = got.filter("held_out").join(labels, "doc_id")  # rows no label was learned from
    assert seen.filter("predicted = quality").count() >= 0.9 * seen.count()


def test_rules_compile_to_what_was_fitted(spark):
    rnd = np.random.default_rng(2)
    x = rnd.random((600, len(rules.STATISTICS)))
    y = ((x[:, 3] > 0.6) & (x[:, 7] < 0.5)).astype(float)
    model = rules.fit(x, y)
    rows = spark.createDataFrame([tuple(map(float, r)) for r in x], list(rules.STATISTICS))
    got = np.array([r.s for r in rows.select(model.column().alias("s")).collect()])
    assert ((got >= 0.5) == (y == 1)).mean() > 0.97
    logit = model.bias + sum(w * rules._holds(x, t) for t, w in model.rules)
    assert np.allclose(np.sort(got), np.sort(1 / (1 + np.exp(-logit))), atol=1e-6)


def test_quality_edges(spark):
    docs = documents(spark, awkward())
    model = rules.RuleModel(0.0, [(((0, 5.0, True),), 1.0)])
    got = rules.score(docs, model, ["doc_id"]).collect()
    assert len(got) == len(awkward()) and all(0 <= r.score <= 1 for r in got)
    assert rules.score(documents(spark, []), model, ["doc_id"]).count() == 0


def test_statistics_of_repetition():
    rnd = random.Random(1)
    junk = rules.statistics("spam " * 50)
    prose = rules.statistics(" ".join(f"w{rnd.randrange(99)}" for _ in range(50)))
    at = rules.STATISTICS.index
    assert junk[at("repeated_next")] == 1 > prose[at("repeated_next")]
    assert junk[at("unique_words")] < 0.1 < prose[at("unique_words")]
