from __future__ import annotations

import random

import pytest
from xxhash import xxh64_intdigest

from tests.conftest import SMALL
from tests.llm.conftest import sentence
from verdigris.llm import simhash as s
from verdigris.llm.components import components
from verdigris.llm.queries import QUERIES


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def brute_print(text):
    words = [w for w in (text or "").encode().lower().replace(b"\x0b", b" ").replace(b"\x0c", b" ").split()]
    if not words:
        return 0
    grams = [b" ".join(words)] if len(words) < 3 else [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    hashes = [xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(points):
    """Smallest reachable value of each unsigned fingerprint."""
    points, seen, root = sorted(set(points)), set(), {}
    for first in points:
        if first in seen:
            continue
        stack, group = [first], []
        seen.add(first)
        while stack:
            x = stack.pop()
            group.append(x)
            for y in points:
                if y not in seen and (x ^ y).bit_count() <= 3:
                    seen.add(y)
                    stack.append(y)
        for x in group:
            root[x] = tuple(sorted(group))
    return root


def test_fingerprints():
    rng = random.Random(3)
    for text in [None, "", " \n", "A", "a B", "a b c", "É é e", *[sentence(rng, n) for n in (3, 10, 500)]]:
        assert s.fingerprint(text) == signed(brute_print(text))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_of_fingerprints_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    points = [rng.getrandbits(64) for _ in range(30)]
    for _ in range(150):  # chains, dense groups and pairs at 1 to 4 bits
        x = rng.choice(points)
        for bit in rng.sample(range(64) if rng.random() < 0.5 else range(8), rng.randrange(1, 5)):
            x ^= 1 << bit
        points.append(x)
    points += [0, 1 << 63, (1 << 64) - 1]
    frame = spark.createDataFrame([(signed(p),) for p in set(points)], "fp long")
    found = {r.fp: r.root for r in s.fingerprint_components(frame).collect()}
    for point, group in brute_components(points).items():
        assert found.get(signed(point), signed(point)) == min(map(signed, group))


def test_query_equals_brute_force(spark):
    found = {r.doc_id: r for r in QUERIES["op5_simhash"](spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    prints = {r.doc_id: brute_print(r.text) for r in docs}
    groups = brute_components(prints.values())
    smallest = {}
    for doc, p in sorted(prints.items()):
        smallest.setdefault(groups[p], doc)
    assert len(found) == len(docs)
    for doc, p in prints.items():
        assert found[doc].fingerprint == f"{p:016x}"
        assert found[doc].component_id == smallest[groups[p]]


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(200)], "a long, b long")
    assert {(r.node, r.root) for r in components(edges).collect()} == {(i, 0) for i in range(1, 201)}
    assert components(edges.filter("a < 0")).count() == 0


def test_one_of_each_group_stays(spark, clashing_docs, no_docs):
    kept = s.keep_one(clashing_docs)
    assert kept.columns == clashing_docs.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    # Null, empty, blank and id-less empty texts share fingerprint zero; one of three equal rows stays.
    assert sorted(i for i in ids if i is not None).count(50) == 1
    assert 0 in ids and 1 not in ids and 2 not in ids
    assert ids.count(None) == 1
    assert s.keep_one(no_docs).count() == 0
    near = s.near_duplicates(clashing_docs)
    assert near.count() == clashing_docs.count()
    assert s.near_duplicates(no_docs).count() == 0
