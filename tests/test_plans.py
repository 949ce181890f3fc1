"""The physical plans the engine counts on."""

import pytest
from conftest import SMALL, plan_of
from pyspark.sql import functions as F

from gatewatch.operators import ingest, metrics, rates, store_queries, users
from gatewatch.plans import testbed
from gatewatch.plans.catalog import catalog

PYTHON_NODES = ("Python", "Pandas")


@pytest.mark.parametrize("name", sorted(n for n in catalog() if not n.startswith("stream_")))
def test_no_python_outside_streams(spark, name):
    plan = plan_of(catalog()[name](spark, SMALL))
    assert not any(word in plan for word in PYTHON_NODES)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_latest_row_is_found_before_the_shuffle(events):
    plan = plan_of(store_queries.active_sessions(events))
    assert plan.count("Exchange") == 1
    assert "partial_max" in plan.split("Exchange")[1]


@pytest.mark.parametrize("make", [
    rates.login_rate_grouping_sets,
    users.users_table,
    lambda e: metrics.label_and_place_counts(e, testbed.AS_OF),
    lambda e: metrics.user_samples(users.user_facts(e)),
    lambda e: ingest.encode(ingest.event_messages(e)),
])
def test_one_scan_for_many_results(events, make):
    assert plan_of(make(events)).count("FileScan") == 1


def test_snapshot_scans_the_events_three_times(events):
    plan = plan_of(metrics.metrics_snapshot(events, testbed.AS_OF, testbed.DURATION_BUCKETS))
    assert plan.count("FileScan") == 3


def test_json_of_the_testbed_is_read_once(spark):
    for name in ("users_table", "security_alerts_current", "rule_unusual_location"):
        assert plan_of(catalog()[name](spark, SMALL)).count("get_json_object") <= 2


def test_coordinates_do_not_multiply_the_label_counts(events):
    moved = events.withColumns({c: F.col(c) + F.rand(3) for c in ("latitude", "longitude")})
    assert metrics.label_counts(moved).count() == metrics.label_counts(events).count()
    assert metrics.place_counts(moved).count() > metrics.place_counts(events).count()


def test_only_needed_columns_are_read(spark):
    plan = plan_of(catalog()["method_metrics"](spark, SMALL))
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in plan


def test_top_rows_need_no_full_sort(events):
    plan = plan_of(store_queries.top_rows(rates.login_rates(events, ["city"]), ["city"], 5))
    assert "TakeOrderedAndProject" in plan


@pytest.mark.parametrize("name", ["valid_events", "dead_letters", "errors_total"])
def test_json_is_parsed_once(spark, name):
    assert plan_of(catalog()[name](spark, SMALL)).count("from_json") == 1


@pytest.mark.parametrize("name, types", [
    ("combo_metrics", "[click,error,view]"), ("session_durations", "[click,error,purchase,view]"),
    ("active_sessions", "[click,error,purchase,view]"), ("logouts_by_device_city", "purchase"),
])
def test_kinds_filter_the_scan(spark, name, types):
    plan = plan_of(catalog()[name](spark, SMALL))
    pushed = plan.split("PushedFilters:")[1].split("ReadSchema")[0]
    assert types in pushed
