from __future__ import annotations

import random

import pytest

from tests.llm.conftest import sentence
from tests.llm.test_simhash import signed
from verdigris.llm import simhash as s


def test_shingle_length_and_radius_are_parameters(spark):
    rng = random.Random(11)
    base = sentence(rng, 400).split()
    texts = [" ".join(base)]
    for at in range(0, 400, 40):  # each text has one more changed word
        base[at] = f"changed{at}"
        texts.append(" ".join(base))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for shingle in (1, 3, 5):
        found = {r.doc_id: r.fp for r in s.near_duplicates(docs, shingle=shingle, radius=3).collect()}
        assert found == {i: s.fingerprint(t, shingle) for i, t in enumerate(texts)}
    assert s.fingerprint("a b c d", 5) == s.fingerprint("A B C  D", 4) != s.fingerprint("a b c d", 3)


def test_radius(spark):
    points = [signed(p) for p in (0, 0b111, 0b111 | 3 << 62, 1 << 20 | 0b111 << 40)]
    frame = spark.createDataFrame([(p,) for p in points], "fp long")
    assert {r.fp for r in s.fingerprint_components(frame, 2).collect()} == {0b111}
    assert {r.fp for r in s.fingerprint_components(frame, 3).collect()} == {0, 0b111}
    with pytest.raises(ValueError):
        s.fingerprint_components(frame, 15)
