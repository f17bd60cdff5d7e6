"""Near-dedup does not broadcast exploded variants, mixing no table of rows."""

from __future__ import annotations

import random

import pytest

from tests.conftest import plan_of
from tests.llm.conftest import sentence
from verdigris.llm import mixing as m, simhash as s


@pytest.mark.parametrize("search", [s.near_duplicates, s.keep_one])
def test_variants_are_not_broadcast(spark, monkeypatch, search):
    plans, far = [], s._far_links

    def record(*args):
        links = far(*args)
        plans.append(plan_of(links))
        return links

    monkeypatch.setattr(s, "_far_links", record)
    rng = random.Random(7)
    rows = []
    for i in range(20):
        words = sentence(rng, 300).split()
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join([*words[:-1], "changed"]))]
    search(spark.createDataFrame(rows, "doc_id long, text string"))
    assert len(plans) == 1 and "SortMergeJoin [half" in plans[0] and "Broadcast" not in plans[0]


def test_mixing_broadcasts_sources_only(spark, monkeypatch):
    plans, store = {}, m.materialize

    def record(df, label):
        plans[label] = plan_of(df)
        return store(df, label)

    monkeypatch.setattr(m, "materialize", record)
    docs = spark.createDataFrame([(i, f"text {i}", "ab"[i % 2]) for i in range(30)], "doc_id long, text string, source string")
    plans["mixed"] = plan_of(m.mix(docs))
    # The decided rows, the hashes taken, and the copies of a row in earlier partitions.
    for label in ("taken", "mixed"):
        assert "SortMergeJoin" in plans[label] and "Broadcast" not in plans[label]
    assert "SortMergeJoin [hash" in plans["rated"]
