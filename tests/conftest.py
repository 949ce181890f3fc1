from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from gatewatch.session import build_session
    session = build_session("tests", "local[8]", {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.maxMetadataStringLength": "5000",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    })
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def events(spark):
    from gatewatch.plans.testbed import login_events
    return login_events(spark, SMALL)


@pytest.fixture
def base(tmp_path):
    return str(tmp_path)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized_plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def rows_of(df) -> list[tuple]:
    """All rows as comparable tuples, columns in name order."""
    names = sorted(df.columns)
    return sorted(tuple(repr(r[n]) for n in names) for r in df.collect())
