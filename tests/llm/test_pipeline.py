from __future__ import annotations

import re
from collections import Counter

import pytest

import corpus_pipeline as p
from tests.conftest import SMALL
from tests.llm import test_decontaminate, test_simhash
from verdigris.session import materialize


def text_rows(df):
    return Counter(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs]
    for name, stage in p.STAGES:
        out.append(materialize(stage(spark, out[-1], SMALL), name))
    return out


def test_stage_columns(steps):
    columns = steps[0].columns
    assert all(df.columns == columns for df in steps[:-1])
    assert steps[-1].columns == [*columns, "shard", "slot"]


def test_language_stage_keeps_whole_rows(steps):
    before, after = text_rows(steps[0]), text_rows(steps[1])
    assert after <= before
    assert sum(after.values()) >= 0.98 * sum(before.values())
    gone = before - after
    assert all(not row[1] or not re.search(r"[^\W\d_]", row[1]) or len(row[1]) < 200 for row in gone)


def test_dedup_stage_keeps_one_of_each_group(steps):
    rows = {r.doc_id: r for r in steps[1].collect()}
    prints = {i: test_simhash.brute_print(r.text) for i, r in rows.items()}
    groups = test_simhash.brute_components(prints.values())
    smallest = {}
    for i in sorted(rows):
        smallest.setdefault(groups[prints[i]], i)
    assert text_rows(steps[2]) == Counter(tuple(rows[i]) for i in smallest.values())


def test_decontamination_stage(spark, steps):
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()
    rows = {r.doc_id: r for r in steps[2].collect()}
    judged = test_decontaminate.brute([(i, r.text) for i, r in rows.items()], items)
    assert text_rows(steps[3]) == Counter(tuple(rows[r[0]]) for r in judged if not r[-1])


def test_mixing_and_sharding_stages(steps):
    before, after = text_rows(steps[3]), text_rows(steps[4])
    assert set(after) <= set(before) and max(after.values()) <= 2
    placed = steps[5].collect()
    assert Counter(tuple(r)[:-2] for r in placed) == after
    shards = Counter(r.shard for r in placed)
    assert sorted(shards) == list(range(8)) and max(shards.values()) - min(shards.values()) <= 1
    assert len({(r.shard, r.slot) for r in placed}) == len(placed)


def test_run_equals_the_stages(spark, steps):
    assert text_rows(p.run(spark, SMALL)) == text_rows(steps[-1])


def test_odd_tables(spark, odd_docs, no_docs, folder):
    items = spark.createDataFrame([(1, None), (None, "same words in every row")], "item_id long, text string")
    path = folder(documents=odd_docs, benchmark=items)
    rows = p.run(spark, path).collect()
    assert not any(r.text and r.text.startswith("same words") for r in rows)
    assert p.run(spark, folder(documents=no_docs, benchmark=items.limit(0))).count() == 0
