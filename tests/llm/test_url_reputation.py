from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from tests.compare import compare, duck
from tests.conftest import SMALL
from verdigris.llm import url_reputation as u
from verdigris.llm.queries import ORACLES, QUERIES

LETTERS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    path = rest[end:]
    stop = min([path.index(c) for c in "?#" if c in path], default=len(path))
    return rest[:end].translate(LETTERS), path[:stop]


def brute_rule(host, path):
    best = None
    for verdict, rule in u.RULES:
        name, _, tail = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + tail):
            if best is None or len(rule) > len(best[0]):
                best = (rule, verdict)
    return best


URLS = [
    None, "", "no scheme", "http://", "HTTP://WWW.Example.NET/en/1?x#y", "https://example.net/en", "x://a.net?q=/en/",
    "http://net/", "http://planet/", "http://example.com/de/a", "http://notexample.com/de/a", "http://ÄB.org/fr/", "http://b.org/fr",
    "http://u:p@h.co.uk:8080/p#f", "http://10.0.0.1/x", "http://[::1]/x", "http://a.b.example.org./", "ftp://x://y/z", "http://a\nb.org/fr/\nz",
]


def test_split_and_rules(spark):
    pages = spark.createDataFrame([(i, url) for i, url in enumerate(URLS)], "page_id long, url string")
    outcomes = spark.createDataFrame([], "page_id long, good int")
    for row in u.filter_urls(pages, outcomes).collect():
        host, path = brute_split(row.url)
        assert (row.host, row.path) == (host, path)
        rule = brute_rule(host, path)
        assert row.rule == (rule and rule[0])
        assert row.verdict == (rule[1] if rule else "block")  # 1/2 less its deviation is below 1/2


def test_shrinkage(spark):
    pages = spark.range(400).select(
        F.col("id").alias("page_id"),
        F.when(F.col("id") < 200, "http://good.a.com/x").when(F.col("id") < 390, "http://bad.b.com/").otherwise("http://new.b.com/").alias("url"),
    )
    marks = spark.range(390).select(F.col("id").alias("page_id"), (F.col("id") < 200).cast("int").alias("good"))
    found = {r.host: r for r in u.filter_urls(pages, marks).select("host", "verdict", "reputation", "bound").distinct().collect()}
    assert found["good.a.com"].verdict == "allow" and found["bad.b.com"].verdict == "block"
    # A host without labels follows its domain, with a wider margin.
    assert found["bad.b.com"].reputation < found["new.b.com"].reputation < 0.3
    assert found["new.b.com"].verdict == "block"
    assert all(math.isfinite(r.bound) for r in found.values())


def test_repeated_and_null_labels(spark):
    pages = spark.createDataFrame([(1, "http://a.com/"), (1, "http://a.com/"), (None, None)], "page_id long, url string")
    labels = spark.createDataFrame([(1, 1), (1, None), (1, 1), (None, 0)], "page_id long, good int")
    clashing = pages.select("*", F.lit(1).alias("host"), F.lit(2).alias("_host"), F.lit(3).alias("verdict"))
    found = u.filter_urls(clashing, labels)
    assert found.columns == ["page_id", "url", "_host", "host", "path", "rule", "verdict", "reputation", "bound"]
    assert found.count() == 3
    assert u.filter_urls(pages.limit(0), labels).count() == 0


@pytest.mark.parametrize("folder", [SMALL, SMALL.replace("0.001", "0.01")])
def test_query_agrees_with_sql(spark, folder):
    name = "op1_url_reputation"
    rows, problem = compare(QUERIES[name](spark, folder), duck(folder), ORACLES[name])
    assert not problem and rows
