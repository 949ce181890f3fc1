"""Hot keys: the slotted lag has to give what one window per key gives."""

import random

import pytest
from conftest import SMALL, plan_of, rows_of
from pyspark.sql import functions as F

from gatewatch.operators import rules, sessions, skew
from gatewatch.operators.skew import lag_by_key
from gatewatch.plans.catalog import catalog


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows belongs to one user; some of its times are equal."""
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        user = "bot" if i % 3 == 0 else f"user_{rng.randrange(200)}"
        rows.append((i, user, 1704067200 + rng.randrange(20000) + rng.randrange(2) / 2,
                     rng.choice("abc")))
    return (spark.createDataFrame(rows, "event_id long, user_id string, t double, v string")
            .withColumn("event_time", F.col("t").cast("timestamp")).drop("t")).cache()


def brute_force_lag(df, offset):
    per_user = {}
    for r in df.collect():
        per_user.setdefault(r["user_id"], []).append((r["event_time"], r["event_id"], r["v"]))
    out = set()
    for rows in per_user.values():
        rows.sort()
        for i, row in enumerate(rows):
            out.add((row[1], rows[i - offset][2] if i >= offset else None))
    return out


@pytest.mark.parametrize("offset", [1, 2, 5])
@pytest.mark.parametrize("slot_seconds", [1, 60, 3600, 10**7])
def test_slotted_lag(skewed, offset, slot_seconds):
    got = lag_by_key(skewed, "user_id", ["event_time", "event_id"], {"prev": "v"}, offset,
                     slot_seconds=slot_seconds)
    assert got.columns == [*skewed.columns, "prev"]
    assert got.count() == skewed.count()
    assert {(r["event_id"], r["prev"]) for r in got.collect()} == brute_force_lag(skewed, offset)


def test_rows_are_not_sorted_by_key_alone(skewed):
    plan = plan_of(lag_by_key(skewed, "user_id", ["event_time", "event_id"], {"prev": "v"}))
    # Rows move by key and slot; rows inside a slot are groups of their own afterwards.
    for moved in plan.split("hashpartitioning(user_id#")[1:]:
        assert "_slot#" in moved.split(")")[0]
    assert "Sample" not in plan and "approx_top_k" not in plan


def test_edges_are_few(skewed):
    """What shares a group in the second window is bounded by the slots."""
    slots = skewed.groupBy("user_id").agg(
        F.count_distinct(F.floor(F.unix_seconds("event_time") / 3600)).alias("n"))
    assert slots.filter("user_id = 'bot'").first()["n"] <= 6


@pytest.mark.parametrize("name", ["session_durations", "session_duration_histogram",
                                  "rule_multiple_failed", "rule_unusual_location",
                                  "rule_device_switch", "metrics_snapshot", "encode_json"])
def test_building_a_query_runs_no_job(spark, name):
    group = f"build-{name}"
    spark.sparkContext.setJobGroup(group, name)
    try:
        catalog()[name](spark, SMALL)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_operators_do_not_depend_on_the_slots(events, monkeypatch):
    def results():
        return [rows_of(df) for df in (
            sessions.session_durations(events), rules.multiple_failed_attempts(events, 3),
            rules.multiple_failed_attempts(events, 1), rules.unusual_location(events),
            rules.rapid_device_switch(events, 86400))]

    narrow = results()
    monkeypatch.setattr(skew.lag_by_key, "__defaults__", (1, 3 * 3600))
    assert results() == narrow
    assert rows_of(sessions.session_durations(events, 10**7)) == narrow[0]
