"""The quality report reads each table once and shuffles keys once."""

from __future__ import annotations

import re

from tests.conftest import plan_of
from verdigris.operators.quality import Checks, dq_report


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_every_kind_of_check(spark):
    child = spark.createDataFrame(
        [(1, 5.0, "a", 1), (1, None, "a", 9), (2, 99.0, None, 9), (None, 3.0, "b", None), (None, -1.0, "b", 2)],
        "k int, v double, s string, p long",
    )
    parent = spark.createDataFrame([(1,), (2,), (2,), (None,)], "p long")
    checks = Checks(not_null=["v", "s"], ranges=[("v", 0, 10)], unique=[["k"], ["k", "s"], ["s"]], references=[("p", parent)])
    report = dq_report({"child": (child, checks), "parent": (parent, Checks(unique=[["p"]]))})
    assert rows(report) == [
        ("child", "accepted_range", "v", 2, 5, "fail"),
        ("child", "not_null", "s", 1, 5, "fail"),
        ("child", "not_null", "v", 1, 5, "fail"),
        ("child", "referential", "p", 2, 5, "fail"),
        ("child", "unique", "k", 1, 5, "fail"),
        ("child", "unique", "k,s", 1, 5, "fail"),
        ("child", "unique", "s", 2, 5, "fail"),
        ("parent", "unique", "p", 1, 4, "fail"),
    ]


def test_empty_tables_pass(spark):
    empty = spark.createDataFrame([], "k int")
    report = dq_report({"t": (empty, Checks(not_null=["k"], unique=[["k"]], references=[("k", spark.range(3).toDF("k"))]))})
    assert {r[3:] for r in rows(report)} == {(0, 0, "pass")}


def test_each_table_is_scanned_once_and_keys_shuffled_once(spark, fresh):
    paths = fresh("child"), fresh("parent")
    spark.range(50).selectExpr("id % 7 as k", "id as v").write.parquet(paths[0])
    spark.range(7).selectExpr("id as k").write.parquet(paths[1])
    child, parent = (spark.read.parquet(p) for p in paths)
    checks = Checks(not_null=["k", "v"], ranges=[("v", 0, 9)], unique=[["v"], ["k"]], references=[("k", parent)])
    plan = plan_of(dq_report({"child": (child, checks), "parent": (parent, Checks(unique=[["k"]]))}))
    assert plan.count("FileScan parquet") == 2
    assert len(re.findall(r"Exchange hashpartitioning\(check_id#\d+, key#", plan)) == 1
    assert "partial_sum" in plan
