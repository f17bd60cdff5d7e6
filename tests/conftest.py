from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from verdigris.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        {
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.warehouse.dir": "/tmp/verdigris-warehouse",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def tables(spark):
    from verdigris.plans.registry import Tables

    return Tables(spark, SMALL)


@pytest.fixture
def fresh(spark):
    """A maker of unused scratch paths."""
    from verdigris.session import scratch_path

    return lambda label="t": scratch_path(spark, label)


def plan_of(df) -> str:
    """Physical plan as text, before execution."""
    return df._jdf.queryExecution().executedPlan().toString()
