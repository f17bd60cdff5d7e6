"""Every query with SQL agrees with DuckDB on the small tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.compare import compare, duck
from tests.conftest import SMALL
from verdigris.plans.registry import ORACLES, QUERIES

# Fitted models take long and have their own tests.
SLOW = {"train_gbt", "train_forecaster", "score_batch"}


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(spark, con, name):
    rows, problem = compare(QUERIES[name](spark, SMALL), con, ORACLES[name])
    assert not problem
    assert rows > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - SLOW))
def test_runs_without_sql(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_flagship(spark):
    daily = entry.entry(spark)
    assert daily.count() == 30
    assert daily.columns[0] == "reading_date"
