"""Relations that hold whatever the data."""

import datetime as dt

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from gatewatch.operators import metrics, rates, rules, sessions, store_queries, users
from gatewatch.operators.ingest import storable


def test_success_and_failure_add_up(events):
    table = rates.login_rates(events, rates.COMBO_KEYS)
    assert table.filter("failed_attempts + successful_attempts <> total_attempts").count() == 0
    assert table.filter("success_rate < 0 OR success_rate > 100").count() == 0


@pytest.mark.parametrize("name", ["city_metrics", "method_metrics", "device_metrics"])
def test_combinations_roll_up(events, name):
    keys = rates.RATE_TABLES[name]
    counts = rates.login_counts(events, rates.COMBO_KEYS)
    assert rows_of(rates.roll_up(counts, keys)) == rows_of(rates.login_rates(events, keys))


def test_grouping_sets_contain_each_table(events):
    sets = rates.login_rate_grouping_sets(events)
    # Bits of rolled-up keys, first key highest: city=4, device=2, method=1.
    ids = {"combo_metrics": 0, "city_metrics": 3, "device_metrics": 5, "method_metrics": 6}
    for name, keys in rates.RATE_TABLES.items():
        part = sets.filter(F.col("grouping_id") == ids[name])
        direct = rates.login_rates(events, keys)
        assert rows_of(part.select(direct.columns)) == rows_of(direct)


def test_histogram_last_bucket_is_the_count(events):
    hist = metrics.histogram(sessions.session_durations(events), "session_duration",
                             ["device_type"], (60.0, 3600.0))
    assert hist.filter("le = '+Inf' AND bucket <> count").count() == 0
    assert hist.filter("bucket > count").count() == 0


def test_active_users_are_users(events):
    active = store_queries.active_sessions(storable(events))
    assert active.count() == active.select("user_id").distinct().count()
    assert active.count() <= events.select("user_id").distinct().count()


def _hand_made(spark, rows):
    columns = ("event_id long, event_time string, user_id string, event_type string, "
               "success boolean, device_id string, device_type string, os_type string, "
               "city string, latitude double, longitude double, failure_reason string, "
               "authentication_method string")
    return (spark.createDataFrame(rows, columns)
            .withColumn("event_time", F.col("event_time").cast("timestamp")))


def _row(i, time, user, kind, success=None, city=None, reason=None, device="d"):
    return (i, f"2024-01-01 {time}", user, kind, success, device, None, "os", city,
            None, None, reason, "2fa" if kind == "login" else None)


def test_null_success_counts_as_attempt_but_not_as_failure_reason(spark):
    df = _hand_made(spark, [
        _row(1, "01:00:00", "u", "login", None, None, "r"),
        _row(2, "02:00:00", "u", "login", False, None, "r"),
        _row(3, "03:00:00", "u", "login", True),
    ])
    row = rates.login_rates(df, ["city"]).first()
    assert (row["city"], row["total_attempts"], row["failed_attempts"]) == (None, 3, 2)
    assert row["success_rate"] == 33.33
    assert [r["count"] for r in rates.failure_counts(df).collect()] == [1]
    assert metrics.counter(df, "authentication_failures_total").first()["value"] == 2


def test_session_pairing(spark):
    df = _hand_made(spark, [
        _row(1, "01:00:00", "a", "logout"),                 # nothing open
        _row(2, "02:00:00", "a", "login", True),
        _row(3, "02:10:00", "a", "login", True),            # replaces the open login
        _row(4, "02:20:00", "a", "login", False),           # failed: ignored
        _row(5, "02:30:00", "a", "logout"),                 # 20 minutes
        _row(6, "02:40:00", "a", "logout"),                 # closed already
    ])
    got = {r["event_id"]: r["session_duration"]
           for r in sessions.session_durations(df).collect()}
    assert got == {1: None, 5: 1200.0, 6: None}


def test_active_sessions_look_at_the_last_event(spark):
    df = _hand_made(spark, [
        _row(1, "01:00:00", "a", "login", True), _row(2, "02:00:00", "a", "logout"),
        _row(3, "01:00:00", "b", "logout"), _row(4, "02:00:00", "b", "login", False),
        _row(5, "01:00:00", "c", "login", True), _row(6, "01:00:00", "c", "logout"),
    ])
    assert [r["user_id"] for r in store_queries.active_sessions(df).collect()] == ["b"]
    assert store_queries.active_sessions(df, successful_only=True).count() == 0


def test_profile_keeps_null_location_of_the_latest_login(spark):
    df = _hand_made(spark, [
        _row(1, "01:00:00", "a", "login", True, "x"),
        _row(2, "02:00:00", "a", "login", False, None),
    ])
    row = users.user_profiles(df).first()
    assert row["last_location"] is None and row["failed_attempts"] == 1
    assert row["last_login"] == dt.datetime(2024, 1, 1, 2)


def test_balance_may_be_negative(spark):
    df = _hand_made(spark, [_row(1, "01:00:00", "a", "logout"),
                            _row(2, "02:00:00", "a", "logout")])
    assert metrics.session_counters(df).first()["active_sessions_total"] == -2
    assert metrics.counter(df, "active_sessions_by_device").first()["value"] == -2


def test_failures_are_counted_from_24_hours_back_inclusive(spark):
    df = _hand_made(spark, [
        _row(1, "01:00:00", "a", "login", False, "x", "r"),
        _row(2, "00:59:59", "a", "login", False, "x", "r"),
    ])
    got = store_queries.recent_failures(df, "2024-01-02 01:00:00").collect()
    assert [(r["city"], r["reason"], r["count"]) for r in got] == [("x", "r", 1)]


def test_multiple_failures_threshold(spark):
    df = _hand_made(spark, [
        _row(1, "01:00:00", "a", "login", False), _row(2, "01:30:00", "a", "login", True),
        _row(3, "02:00:00", "a", "login", False), _row(4, "02:30:00", "a", "login", False),
    ])
    ids = {r["event_id"] for r in rules.multiple_failed_attempts(df, 2, 3600).collect()}
    assert ids == {3, 4}
    ids = {r["event_id"] for r in rules.multiple_failed_attempts(df, 3, 3600).collect()}
    assert ids == set()


def test_top_rows_ignores_missing_columns(events):
    table = rates.login_rates(events, ["city"])
    assert store_queries.top_rows(table, ["nope", "city"], 3).count() == 3
    assert store_queries.top_rows(table, ["nope"], 2).count() == 2
