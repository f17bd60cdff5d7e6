from __future__ import annotations

import random
import zlib

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import sentence
from verdigris.llm import language_id as li, pu_quality as pu, toxicity as tox
from verdigris.llm.common import fold
from verdigris.llm.queries import QUERIES

MEDIUM = "/root/testdata/sf0.01"


def crc(doc_id, folds):
    return zlib.crc32(str(doc_id).encode()) % folds


def area(pairs):
    """Area under the curve of (label, score) pairs."""
    good = [s for y, s in pairs if y]
    bad = [s for y, s in pairs if not y]
    return sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / len(good) / len(bad)


def labels(spark, column):
    return {r.doc_id: r[column] for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}


def test_language_of_held_out_documents(spark):
    rows = QUERIES["op3_language_id"](spark, MEDIUM).collect()
    known = {r.doc_id: r.lang for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").collect()}
    assert len(rows) == len(known)
    assert all(r.held_out == (crc(r.doc_id, 3) == 1) and 0 <= r.score <= 1 for r in rows)
    held_out = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == known[r.doc_id] for r in held_out) >= 0.99 * len(held_out)


def brute_rows(model, word):
    tables = model.rows
    if word in tables[0]:
        return [tables[0][word]]
    for n in (5, 4, 3, 2, 1):
        padded = word if n == 1 else f" {word} "
        found = [tables[n][padded[i : i + n]] for i in range(len(padded)) if padded[i : i + n] in tables[n]]
        if found:
            return found
    return []


def test_words_come_first_and_back_off(spark):
    rows = [(i, "the cat sat on the mat", "en") for i in range(5)] + [(9 + i, "die katze saß auf der matte", "de") for i in range(5)]
    frame = spark.createDataFrame([*rows, (30, None, "en"), (31, "x", None)], "doc_id long, text string, lang string")
    model = li.fit(frame)
    assert model.languages == ["de", "en"]
    for word in ("cat", "cats", "kat", "q", "e", "matte"):
        assert model.rows_of(word) == brute_rows(model, word)
    assert len(model.rows_of("the")) == 1 and len(model.rows_of("thes")) >= 1
    judged = model.judge(["The CAT", "Katzen", None, "", "12 !?", "жжж", "the " * 50_000])
    assert [lang for lang, _ in judged] == ["en", "de", "und", "und", "und", "und", "en"]
    assert model.judge(["cat"]) == model.judge(["cat", "dog", "cat"])[2:]


def test_language_of_odd_rows(spark, clashing_docs, no_docs):
    judged = li.identify(clashing_docs, li.fit(clashing_docs))
    assert judged.columns == [*[c for c in clashing_docs.columns if c != "score"], "lang_pred", "score"]
    assert judged.count() == clashing_docs.count()
    untaught = li.fit(no_docs)
    assert {r.lang_pred for r in li.identify(clashing_docs, untaught).collect()} == {"und"}
    kept = li.keep_confident(clashing_docs, li.fit(clashing_docs), 0.5)
    assert kept.columns == clashing_docs.columns
    assert li.identify(no_docs, untaught).count() == 0


@pytest.mark.parametrize(
    ("name", "column", "folds", "out", "least"),
    [("op6_toxicity", "toxic", 5, 0, 0.9), ("op10_pu_quality", "quality", 3, 1, 0.95)],
)
def test_scores_of_held_out_documents(spark, name, column, folds, out, least):
    rows = QUERIES[name](spark, MEDIUM).collect()
    assert len(rows) == spark.read.parquet(f"{MEDIUM}/documents.parquet").count()
    assert all(r.held_out == (crc(r.doc_id, folds) == out) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    known = labels(spark, column)
    held_out = [(known[r.doc_id], r.score, r.predicted) for r in rows if r.held_out and r.doc_id in known]
    assert area([(y, s) for y, s, _ in held_out]) >= least
    assert sum(y == p for y, _, p in held_out) >= 0.9 * len(held_out)


def test_lexicon_features():
    lexicon = tox.Lexicon({"idiot": 6.0, "scum": 5.0, "mora*": 4.0, "meh": 2.5})
    row = lambda text: dict(zip(tox.FEATURES, tox.features_of(text, lexicon, {}), strict=True))
    plain = row("nothing to see")
    assert plain["top_odds"] == plain["strong_rate"] == plain["hidden_log"] == 0
    found = row("You idiot! SCUM!! moralist meh")
    assert found["top_odds"] == 6 and found["second_odds"] == 5
    assert found["strong_rate"] == 3 / 5 and found["mild_rate"] == 1 / 5 and found["prefix_rate"] == 1 / 5
    assert found["near_second"] > 0 and found["shouted_rate"] == 1 / 5
    for hidden in ("1d10t", "idiooooot", "$cum"):
        assert row(hidden)["hidden_log"] > 0
    assert row("i d i o t")["spelled_log"] > 0
    assert len(tox.features_of(None, lexicon, {})) == len(tox.FEATURES)
    assert tox.features_of("", lexicon, {}) == tox.features_of(None, lexicon, {})


@pytest.mark.parametrize("taught", [True, False])
def test_toxicity_of_odd_rows(spark, odd_docs, no_docs, taught):
    docs = odd_docs.select(F.col("doc_id").alias("key"), "text")
    pairs = [(i, i % 2) for i in range(9)] + [(3, 1), (None, 1), (4, None)] if taught else []
    known = spark.createDataFrame(pairs, "key long, label int")
    scores = tox.score_toxicity(docs, known)
    assert scores.count() == docs.count()
    assert all(0 <= r.score <= 1 for r in scores.collect())
    assert tox.score_toxicity(docs.limit(0), known).count() == 0


@pytest.mark.parametrize("taught", [True, False])
def test_quality_of_odd_rows(spark, odd_docs, taught):
    docs = odd_docs.select(F.col("doc_id").alias("key"), "text")
    known = spark.createDataFrame([(5,), (6,), (6,), (None,)] if taught else [], "key long")
    scores = pu.score_quality(docs, known)
    assert scores.count() == docs.count()
    assert all(0 <= r.score <= 1 for r in scores.collect())
    if not taught:
        assert {r.score for r in scores.collect()} == {0.5}
        assert pu.score_quality(docs.limit(0), known).count() == 0


def test_prior_and_risk_without_bad_labels(spark):
    """A third of the unlabelled documents is shouted; only good ones are known."""
    rng = random.Random(8)
    rows = []
    for i in range(600):
        text = sentence(rng, 60)
        rows.append((i, text.upper().replace(" ", "!! ") if i % 3 == 0 else text))
    docs = spark.createDataFrame(rows, "key long, text string")
    known = docs.filter("key % 3 <> 0 and key % 2 = 0").select("key")
    scores = {r.key: r.score for r in pu.score_quality(docs, known).collect()}
    assert sum((s >= 0.5) == (k % 3 != 0) for k, s in scores.items()) >= 0.98 * len(scores)


def test_folds(spark):
    ids = spark.createDataFrame([(0,), (7,), (-3,), (None,)], "doc_id long")
    got = [(r.doc_id, r.f) for r in ids.select("doc_id", fold("doc_id", 5).alias("f")).collect()]
    assert got == [(0, crc(0, 5)), (7, crc(7, 5)), (-3, crc(-3, 5)), (None, 0)]
