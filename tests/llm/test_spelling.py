from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from tests.conftest import SMALL
from verdigris.llm import spelling
from verdigris.llm.queries import QUERIES

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def brute_words(rows, least_letters=6, least_count=5):
    counted = Counter()
    for key, text in rows:
        for run in RUN.findall(text or ""):
            word = run.translate(LOWER)
            code = zlib.crc32(f"{'' if key is None else key}:{word}".encode())
            if code % 199 == 0:
                at = code % len(word)
                word = word[:at] + word[at + 1 :]
            counted[word] += 1
    return {w: n for w, n in counted.items() if len(w) >= least_letters and n >= least_count}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute_groups(words):
    near = {w: set() for w in words}
    for w in words:  # neighbours through the words that one deletion leaves
        for i in range(len(w)):
            near.setdefault(w[:i] + w[i + 1 :], set())
    left = {}
    for w in words:
        for v in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            left.setdefault(v, []).append(w)
    near = {w: set() for w in words}
    for group in left.values():
        for a in group:
            near[a].update(b for b in group if one_edit(a, b))
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * n else None
    rows = set()
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows.add((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return rows


def as_set(df):
    rows = df.select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len(rows) == len(set(rows))
    return {tuple(r) for r in rows}


@pytest.mark.parametrize("folder", [SMALL, "/root/testdata/sf0.01"])
def test_query_equals_brute_force(spark, folder):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert as_set(QUERIES["op13_spelling_variants"](spark, folder)) == brute_groups(brute_words(rows))


def test_dense_words_of_every_length(spark):
    rng = random.Random(3)
    words = {"".join(rng.choice("abé") for _ in range(rng.randrange(1, 9))): rng.randrange(1, 4000) for _ in range(900)}
    words |= {"a" * n: 7**n for n in range(1, 12)} | {"z": 1, "ab" * 6: 9, "ab" * 6 + "a": 90}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    assert as_set(spelling.group_variants(frame)) == brute_groups(words)


def test_long_words_meet_on_hashes(spark):
    rng = random.Random(6)
    base = ["".join(rng.choice("abc") for _ in range(n)) for n in (7, 8, 9, 12, 40)]
    words = {}
    for word in base:
        for _ in range(12):
            at = rng.randrange(len(word))
            kind = rng.randrange(3)
            words[word[:at] + rng.choice("abc") * (kind > 0) + word[at + (kind < 2) :]] = rng.randrange(5, 5000)
        words[word] = 30
    huge = "".join(rng.choice("abc") for _ in range(3_000))
    words |= {huge: 500, huge[:70] + huge[71:]: 9, huge + "a": 8, huge[1:] + "b": 7}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    assert as_set(spelling.group_variants(frame, longest=8)) == brute_groups(words)
    assert as_set(spelling.group_variants(frame)) == brute_groups(words)


def test_counts_in_small_tables(spark, monkeypatch):
    rng = random.Random(9)
    body = " ".join(rng.choice(["Straße", "STRASSE", "naïveté", "letters", "LETTERS", "lettres"]) for _ in range(6_000))
    rows = [(i, body[i * 50 : i * 50 + 9_000]) for i in range(300)] + [(None, body), (7, "lettersĀletters ÷×ÿÀ_x1y" * 9)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    expected = brute_words(rows)
    assert any(w not in body.lower() for w in expected)  # damaged words
    for held in (10**6, 3):
        monkeypatch.setattr(spelling, "HELD_WORDS", held)
        assert {r.word: r.n for r in spelling.count_words(frame).collect()} == expected


def test_odd_rows(spark, odd_docs, clashing_docs, no_docs):
    expected = brute_words([(r.doc_id, r.text) for r in odd_docs.collect()])
    for docs in (odd_docs, clashing_docs.withColumnRenamed("size", "word")):
        counted = spelling.count_words(docs)
        assert {r.word: r.n for r in counted.collect()} == expected
    assert as_set(spelling.group_variants(counted)) == brute_groups(expected)
    assert spelling.group_variants(spelling.count_words(no_docs)).count() == 0
