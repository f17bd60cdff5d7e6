from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL, plan_of
from tests.llm.conftest import DOC_SCHEMA
from verdigris.llm import mixing as m, sharding as sh
from verdigris.llm.queries import QUERIES


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = share * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(capped.values())
        target = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s: most * sizes[s] for s in free if target[s] > most * sizes[s]}
        if not over:
            return {**capped, **target}
        capped |= over


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 100, "b": 100, "c": 100, None: 50},
        {"a": 1, "b": 1000, "é": 10, "z": 0, "Z": 500},
        {"a": 7},
        {"a": 0, "b": 0},
        {str(i): (i * 37) % 91 for i in range(25)},
    ],
)
def test_targets_equal_repeated_resharing(spark, sizes):
    frame = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, size long")
    found = {r.source: r.target for r in m.source_targets(frame).collect()}
    assert found == pytest.approx(brute_targets(sizes))


def test_query_keeps_targets_and_limits(spark):
    first = QUERIES["op9_pivotal_mixing"](spark, SMALL).collect()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    count = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in docs.collect()}
    sizes, taken, longest, targets = Counter(), Counter(), defaultdict(int), {}
    for r in first:
        assert r.size == count[r.doc_id]
        assert 0 <= r.taken <= 2 * r.size
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        longest[r.source] = max(longest[r.source], r.size)
        targets[r.source] = r.target
    assert targets == pytest.approx(brute_targets(sizes))
    for source in sizes:
        assert abs(taken[source] - targets[source]) <= longest[source]
    again = QUERIES["op9_pivotal_mixing"](spark, SMALL).orderBy("doc_id").collect()
    assert sorted(first, key=lambda r: r.doc_id) == again


def test_rounding_keeps_sums_through_several_levels(spark):
    sized = spark.range(3000).select(
        F.col("id").alias("row"), F.lit("s").alias("source"), (F.col("id") % 37).alias("size"), F.xxhash64("id").alias("hash")
    )
    targets = sized.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("target", F.col("source_size") * 0.37)
    rounded = m.round_copies(sized, targets, block=4).collect()
    assert len(rounded) == 3000
    assert {r.copies for r in rounded} == {0, 1}
    assert abs(sum(r.copies * r.size for r in rounded) - rounded[0].target) <= 36
    # Every size class keeps its expectation: no bias towards small or large documents.
    large = [r.copies for r in rounded if r.size >= 18]
    assert 0.30 < sum(large) / len(large) < 0.44


def test_mix_repeats_whole_rows(spark, clashing_docs, no_docs):
    mixed = m.mix(clashing_docs)
    assert mixed.columns == clashing_docs.columns
    plan = m.plan_mix(clashing_docs)
    assert plan.count() == clashing_docs.count()
    assert mixed.count() == plan.agg(F.sum("copies")).first()[0]
    assert m.mix(no_docs).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 3, 8, 97, 1000])
def test_permutation(spark, n):
    place = sorted(r[0] for r in spark.range(n).select(sh.permute(F.col("id"), n)).collect())
    assert place == list(range(n))


def test_query_shards(spark):
    found = QUERIES["op8_feistel_sharding"](spark, SMALL).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    slots = defaultdict(list)
    for r in found:
        raw = (docs[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(raw) + 1, zlib.crc32(raw))
        slots[r.shard].append(r.slot)
    assert sorted(slots) == list(range(8))
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    for own in slots.values():
        assert sorted(own) == list(range(len(own)))
    again = QUERIES["op8_feistel_sharding"](spark, SMALL).collect()
    assert sorted(found) == sorted(again)


def test_sharding_of_odd_rows(spark, clashing_docs, no_docs):
    placed = sh.shard_documents(clashing_docs, 4)
    assert placed.columns == [*[c for c in clashing_docs.columns if c not in ("shard", "slot")], "shard", "slot"]
    assert placed.select("shard", "slot").distinct().count() == clashing_docs.count()
    assert sh.shard_documents(no_docs, 4).count() == 0
    null = sh.describe(clashing_docs.filter("text is null")).first()
    assert (null.size, null.text_crc32) == (1, None)


def test_native_operators_run_no_python(spark, odd_docs):
    assert "Python" not in plan_of(m.mix(odd_docs)) + plan_of(sh.shard_documents(odd_docs, 8))


def test_equal_rows_spread_over_the_buckets_of_their_source(spark):
    """A third of all rows are copies of one; copies and layouts do not change what is taken."""
    rows = [(i, f"{'word ' * (1 + i % 5)}{i}", "en", "s1", 1) for i in range(4_000)] + [(-1, "same words", "en", "s1", 1)] * 2_000
    docs = spark.createDataFrame(rows, DOC_SCHEMA)

    def taken(layout):
        plan = m.plan_mix(layout)
        return sorted(map(tuple, plan.groupBy("doc_id").agg(F.sum("copies")).collect()))

    lots = m.apart(m.measure(docs.repartition(7)))
    assert lots.select("lot").distinct().count() == len(rows)
    buckets = -(-len(rows) // m.BLOCK)
    sizes = [r["count"] for r in lots.groupBy(F.pmod("lot", F.lit(buckets))).count().collect()]
    assert max(sizes) < 1.4 * m.BLOCK
    assert taken(docs.repartition(7)) == taken(docs.repartition(3))
