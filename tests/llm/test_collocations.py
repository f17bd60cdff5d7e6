from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from tests.compare import duck
from verdigris.llm import collocations as c
from verdigris.llm.queries import ORACLES, QUERIES

LOWER = {x: x + 32 for x in range(0x41, 0x5B)}


def brute_counts(rows, longest=5):
    counts = {}
    for lang, text in rows:
        own = counts.setdefault(lang or "und", Counter())
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = [w for w in re.split("[\x20\x09]+", piece) if w]
            for k in range(1, longest + 1):
                own.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    return counts


def brute(rows, threshold, longest=5, top=2000):
    out = []
    for lang, f in brute_counts(rows, longest).items():
        n = sum(x for p, x in f.items() if len(p) == 1)
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= threshold}
        inside = {}
        for p, a in found.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i : i + k]] = max(inside.get(p[i : i + k], 0), a)
        scored = []
        for p, a in found.items():
            cuts = [(1000 * a * n // (f[p[:i]] * f[p[i:]]), i, f[p[:i]], f[p[i:]]) for i in range(1, len(p))]
            score, _, left, right = min(cuts)
            if inside.get(p, 0) < a:
                scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def prose(rng, size):
    words = ["The", "of", "new", "york", "New", "York", "city", "é", "Ω.", "a\tb", "stock,", "exchange", "\x00x", "ünter\xa0x"]
    text = []
    while len(text) < size:
        text.append(rng.choice(["new york stock exchange", "in the city of", *words, f"w{rng.randrange(400)}"]))
    return rng.choice([" ", "  "]).join(text)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(12)
    rows = [(rng.choice(["en", "en", "de", None, "und"]), prose(rng, rng.randrange(0, 150))) for _ in range(150)]
    return rows + [("en", None), ("fr", ""), (None, " .,;:!?\n\t "), ("de", "x y " * 4_000)] + [("en", "copy of a copy")] * 40


@pytest.mark.parametrize(
    "settings",
    [
        {},
        {"shards": 1},
        {"shards": 5, "slots": 64},  # nearly every slot is shared
        {"shards": 3, "block_words": 100},
        {"shards": 2, "slots": 1},
        {"longest": 3},
    ],
)
def test_any_setting_equals_brute_force(spark, texts, settings):
    frame = spark.createDataFrame(texts, "lang string, text string").repartition(3)
    counted = c.count_phrases(frame, threshold=12, **settings)
    longest = settings.get("longest", 5)
    assert rows_of(c.mine(counted)) == brute(texts, 12, longest)
    assert rows_of(c.mine(counted, top=7)) == brute(texts, 12, longest, top=7)


def test_late_phrases_are_complete(spark):
    """Words and phrases that reach the threshold in the last shard, of every length."""
    rng = random.Random(4)
    rows = [("en", " ".join(rng.choices("abcdef", weights=[9, 5, 3, 2, 1, 1], k=30))) for _ in range(60)]
    frame = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    for threshold in (3, 11, 40):
        assert rows_of(c.mine(c.count_phrases(frame, threshold=threshold, shards=4))) == brute(rows, threshold)


def test_products_beyond_64_bits(spark):
    big = 4_000_000_000_000
    counted = spark.createDataFrame(
        [("en", "", 0, 9 * 10**17), ("en", "a", 1, big + 1), ("en", "b", 1, big + 7), ("en", "a b", 2, big)],
        "lang string, phrase string, k int, f long",
    )
    (row,) = c.mine(counted).collect()
    assert row.score == 1000 * big * 9 * 10**17 // ((big + 1) * (big + 7))


def test_sql_equals_the_query(spark):
    folder = "/root/testdata/sf0.01"
    found = rows_of(QUERIES["op12_collocations"](spark, folder))
    stated = duck(folder).sql(ORACLES["op12_collocations"])
    assert found == sorted(tuple(r) for r in stated.fetchall()) and found


def test_odd_rows(spark, odd_docs, clashing_docs, no_docs):
    rows = [(r.lang, r.text) for r in odd_docs.collect()]
    for docs in (odd_docs, clashing_docs.selectExpr("*", "1 as k", "'x' as phrase")):
        assert rows_of(c.mine(c.count_phrases(docs, threshold=3))) == brute(rows, 3)
    assert c.mine(c.count_phrases(no_docs)).count() == 0


@pytest.mark.parametrize(
    "settings", [{"tally_slots": 1}, {"tally_slots": 200}, {"tally_slots": 100_000}, {"block_words": 100, "shards": 3}]
)
def test_shared_slots_of_the_tally_change_nothing(spark, texts, settings):
    frame = spark.createDataFrame(texts, "lang string, text string").repartition(3)
    for threshold in (12, 300):
        assert rows_of(c.mine(c.count_phrases(frame, threshold=threshold, **settings))) == brute(texts, threshold)


def test_rare_pairs_of_frequent_words_are_not_kept(spark, monkeypatch):
    """All pairs but two are rare, though 150 words are frequent."""
    rng = random.Random(9)
    rows = [("en", " ".join(f"w{rng.randrange(150)}" for _ in range(40))) for _ in range(300)]
    rows += [("en", f"r{i} new york city") for i in range(60)]
    sent = []

    def spy(df, label, store=c.materialize):
        stored = store(df, label)
        sent.append((label, stored.count()))
        return stored

    monkeypatch.setattr(c, "materialize", spy)
    frame = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    assert rows_of(c.mine(c.count_phrases(frame, threshold=40))) == brute(rows, 40)
    # the row of no words, 150 + 3 + 60 words, 2 pairs, 1 triple
    assert max(n for label, n in sent if label == "phrase-counts") <= 217
