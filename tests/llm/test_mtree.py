from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from verdigris.llm import mtree
from verdigris.llm.queries import QUERIES


def brute(rows, asks, k):
    points = [
        (i, [math.floor(256 * x) for x in v])
        for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for i, q in {(i, tuple(q)) for i, q in points if asks(i)}:
        scored = sorted((-sum(map(int.__mul__, q, v)), j) for j, v in points if j != i and len(v) == len(q))
        out += [(i, rank, j, -s) for rank, (s, j) in enumerate(scored[:k], 1)]
    return sorted(out)


def test_query_equals_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    found = sorted(map(tuple, QUERIES["op7_mtree_topk"](spark, SMALL).collect()))
    assert found == brute(rows, lambda i: i % 50 == 0, 5)
    assert found


@pytest.mark.parametrize("sample", [mtree.SAMPLE, 3])
def test_hard_cases_equal_brute_force(spark, monkeypatch, sample):
    """Ties, one very common vector, several lengths, scales, blocks and shards; bad vectors."""
    monkeypatch.setattr(mtree, "SAMPLE", sample)
    monkeypatch.setattr(mtree, "SHARD_ROWS", 40)
    monkeypatch.setattr(mtree, "PAGE", 4)
    monkeypatch.setattr(mtree, "QUERY_BLOCK", 7)
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(300)]
    rows += [(i, [0.5, -0.25, 0.0, 1.0, 0.0, 0.0]) for i in range(300, 500)]
    rows += [(i, [float(rng.randrange(-2, 3)) for _ in range(3)]) for i in range(500, 620)]
    rows += [(i, [1000.0 * rng.random() for _ in range(6)]) for i in range(620, 640)]
    rows += [(640, None), (650, []), (660, [1.0, None, 1.0]), (670, [math.nan] * 6), (680, [math.inf] * 6), (None, [1.0] * 6)]
    rows += [(700, [1.0]), (710, [0.0] * 6), (720, [2.0, 2.0]), (730, [3.0, 3.0]), (300, [0.5, -0.25, 0.0, 1.0, 0.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit(1))
    found = mtree.top_products(frame, F.col("vec_id") % 10 == 0, 5)
    assert sorted(map(tuple, found.collect())) == brute(rows, lambda i: i % 10 == 0, 5)


def test_empty(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert mtree.top_products(frame, F.col("vec_id") % 50 == 0, 5).count() == 0
    alone = spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<float>")
    assert mtree.top_products(alone, F.col("vec_id") % 50 == 0, 5).count() == 0


def test_large_components_and_many_lengths_equal_brute_force(spark, monkeypatch):
    """Scores far beyond 2^53, differing in the last digits, and more lengths than fit a group."""
    monkeypatch.setattr(mtree, "SHARD_ROWS", 60)
    monkeypatch.setattr(mtree, "PAGE", 8)
    monkeypatch.setattr(mtree, "QUERY_BLOCK", 5)
    monkeypatch.setattr(mtree, "LENGTHS", 4)
    rng = random.Random(11)
    base = [rng.uniform(1e5, 1e6) for _ in range(5)]
    rows = [(i, [x + rng.randrange(3) / 256 for x in base]) for i in range(200)]
    rows += [(i, [rng.uniform(-1e6, 1e6) for _ in range(5)]) for i in range(200, 300)]
    rows += [(i, [rng.uniform(-1, 1) for _ in range(1 + i % 70)]) for i in range(300, 480)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = sorted(map(tuple, mtree.top_products(frame, F.col("vec_id") % 10 == 0, 5).collect()))
    assert found == brute(rows, lambda i: i % 10 == 0, 5)
    assert max(score for *_, score in found) > 1 << 53


def test_scores_beyond_64_bits_rank_exactly(spark):
    rows = [(0, [1e9, 1e9, 1.0])] + [(i, [1e9, 1e9, float(i % 7)]) for i in range(1, 60)] + [(60, [1e300, 0.0, 0.0]), (61, [-1e300, 0.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = sorted(map(tuple, mtree.top_products(frame, F.col("vec_id") % 50 == 0, 61).collect()))
    limit = 1 << 63
    want = [(q, r, v, min(max(s, -limit), limit - 1)) for q, r, v, s in brute(rows, lambda i: i % 50 == 0, 61)]
    assert found == want


def test_places_sort_like_integers():
    values = [0, 1, -1, 255, 256, -255, -256, -257, 1 << 70, -(1 << 70), (1 << 70) + 1, 1 - (1 << 70), 1 << 2000, -(1 << 2000)]
    assert sorted(values) == sorted(values, key=mtree._place)


def test_no_query_passes_the_driver(spark, monkeypatch):
    """One grouped search, whatever the number of query blocks."""
    monkeypatch.setattr(mtree, "QUERY_BLOCK", 3)
    frame = spark.createDataFrame([(i, [float(i % 13), float(i % 7)]) for i in range(400)], "vec_id long, embedding array<double>")
    found = mtree.top_products(frame, F.col("vec_id") % 4 == 0, 2)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FlatMapCoGroupsInPandas") == 1 and plan.count("FlatMapGroupsInPandas") == 0
    assert found.count() == 200
