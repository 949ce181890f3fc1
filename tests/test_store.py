"""Event store: routing into tables, repeated batches, pruning."""

import datetime as dt
import json
from types import SimpleNamespace

import pytest
from conftest import SMALL, plan_of, rows_of
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from gatewatch.operators import ingest, metrics, store_queries, users
from gatewatch.plans import testbed
from gatewatch.sources import store as store_module
from gatewatch.sources.folders import shared_folder
from gatewatch.sources import store as store_module
from gatewatch.sources.folders import write_text
from gatewatch.sources.store import STORE_SCHEMA, EventStore


@pytest.fixture(scope="module")
def raw(spark):
    return testbed.raw_messages(spark, SMALL)


# The time of messages that carry none.
def stamp():
    return F.lit("2024-01-31 00:00:00").cast("timestamp")


def filled(store, raw):
    store.append(raw.filter("event_id < 500"), 0, default_time=stamp())
    store.append(raw.filter("event_id >= 500"), 1, default_time=stamp())
    store.append(raw.filter("event_id >= 500"), 1, default_time=stamp())  # repeated
    return store


@pytest.fixture(scope="module")
def store(spark, raw, tmp_path_factory):
    return filled(EventStore(spark, str(tmp_path_factory.mktemp("store"))), raw)


def valid_of(raw):
    return ingest.valid_events(raw, default=stamp()).withColumn(
        "failure_reason", F.nullif("failure_reason", F.lit("")))


def test_tables_hold_each_message_once(store, raw):
    valid = valid_of(raw)
    for name, kinds in ((store_module.LOGIN_EVENTS, ["login", "logout"]),
                        (store_module.SECURITY_EVENTS, ["suspicious_activity"]),
                        (store_module.REGISTRATIONS, ["registration"])):
        expected = valid.filter(F.col("event_type").isin(kinds))
        columns = ["event_id", "event_time", "user_id", "event_type", "city", "risk_level"]
        assert rows_of(store.table(name).select(columns)) == rows_of(expected.select(columns))
    columns = ["event_id", "error_type", "details", "event_data"]
    assert (rows_of(store.system_errors().select(columns))
            == rows_of(ingest.dead_letters(raw).select(columns)))


def test_questions_to_the_store(store, raw):
    valid = valid_of(raw)
    for name, df in store.login_metrics().items():
        twin = {"login_attempts_by_method": store_queries.attempts_by_method,
                "device_distribution": store_queries.device_distribution,
                "location_distribution": store_queries.location_distribution}[name](valid)
        assert rows_of(df) == rows_of(twin)
    assert (rows_of(store.security_metrics(testbed.AS_OF))
            == rows_of(store_queries.recent_failures(valid, testbed.AS_OF)))
    assert (rows_of(store.active_sessions().select("user_id", "event_id"))
            == rows_of(store_queries.active_sessions(valid).select("user_id", "event_id")))
    assert rows_of(store.users()) == rows_of(users.users_table(valid))
    history = store.login_history("user_3", "2024-01-05", "2024-01-20")
    assert (rows_of(history.select("event_id"))
            == rows_of(store_queries.login_history(valid, "user_3", "2024-01-05", "2024-01-20")
                       .select("event_id")))
    times = [r["event_time"] for r in history.collect()]
    assert times == sorted(times, reverse=True)


def test_filters_reach_the_files(store):
    plan = plan_of(store.security_metrics(testbed.AS_OF))
    partition, pushed = plan.split("PartitionFilters:")[1].split("PushedFilters:")
    assert "event_date" in partition and "table=login_events" in plan
    assert "EqualTo(success," in pushed and "GreaterThanOrEqual(event_time" in pushed
    plan = plan_of(store.login_history("user_3", "2024-01-05"))
    assert "EqualTo(user_id,user_3)" in plan.split("PushedFilters:")[1]
    assert "event_date" in plan.split("PartitionFilters:")[1].split("PushedFilters:")[0]


def test_without_rebalance_and_sorted_by_user(spark, raw, store, tmp_path):
    other = EventStore(spark, str(tmp_path / "s"))
    other.append(raw, 0, rebalance=False, default_time=stamp())
    assert rows_of(other.login_events()) == rows_of(store.login_events())
    users_in_file = [r["user_id"] for r in spark.read.parquet(
        f"{other.path}/table=login_events/event_date=2024-01-07/batch=0").collect()]
    assert len(users_in_file) > 5 and users_in_file == sorted(users_in_file)


def test_table_without_rows(spark, tmp_path):
    empty = EventStore(spark, str(tmp_path))
    assert empty.login_events().count() == 0
    assert empty.active_sessions().count() == 0


def test_metrics_of_the_store(store, raw):
    expected = metrics.metrics_snapshot(valid_of(raw), testbed.AS_OF, testbed.DURATION_BUCKETS,
                                        ingest.dead_letters(raw), prefix="stored_")
    got = store.metrics(testbed.AS_OF, testbed.DURATION_BUCKETS)
    assert rows_of(got) == rows_of(expected)
    # Event counters of the store are not those of the decoded stream.
    names = {r["metric"] for r in got.collect()}
    assert "stored_login_events_total" in names and "login_events_total" not in names


def test_stored_rows_are_not_judged_again(spark, tmp_path):
    """An event without device fields passes once and then counts everywhere."""
    store = EventStore(spark, str(tmp_path))
    message = {"event_type": "login", "user_id": "u", "device_info": {}, "success": False,
               "authentication_method": "2fa", "failure_reason": "",
               "timestamp": "2024-01-30T12:00:00"}
    store.append(spark.createDataFrame([(1, json.dumps(message))], "event_id long, value string"),
                 0)
    got = {(r["metric"], r["value"]) for r in store.metrics(testbed.AS_OF, (1.0,)).collect()}
    assert {("stored_login_events_total", 1.0), ("concurrent_users_current", 1.0),
            ("user_status_current", 1.0), ("security_alerts_current", 1.0)} <= got
    row = store.security_metrics(testbed.AS_OF).first()
    assert row["reason"] is None and row["count"] == 1


def test_times_that_messages_lack(spark, tmp_path):
    """The broker's time counts, else the given one; unreadable times are dead letters."""
    store = EventStore(spark, str(tmp_path))
    message = {"event_type": "logout", "user_id": "u", "device_info": {"device_id": "d"}}
    rows = [(0, json.dumps(message), dt.datetime(2024, 1, 5)), (1, json.dumps(message), None),
            (2, json.dumps({**message, "timestamp": 99999999999999999}), dt.datetime(2024, 1, 6))]
    store.append(spark.createDataFrame(rows, "event_id long, value string, timestamp timestamp"),
                 0, default_time=stamp())
    got = {r["event_id"]: (str(r["event_time"]), str(r["event_date"]))
           for r in store.rows("login_events").withColumn(
               "event_time", F.col("event_time").cast("string")).collect()}
    assert got == {0: ("2024-01-05 00:00:00", "2024-01-05"),
                   1: ("2024-01-31 00:00:00", "2024-01-31")}
    errors = store.table("system_errors").select("event_id", "error_type", "event_date").collect()
    assert [(r[0], r[1], str(r[2])) for r in errors] == [(2, "bad_timestamp", "2024-01-06")]


def test_compaction_changes_no_answer(spark, raw, tmp_path):
    store = EventStore(spark, str(tmp_path / "s"))
    for batch in (0, 1):
        store.append(raw.filter(f"event_id % 2 = {batch}"), batch, default_time=stamp())

    def answers():
        return [rows_of(df) for df in (
            store.login_events(), store.security_events(), store.system_errors(), store.users(),
            store.security_metrics(testbed.AS_OF),
            store.metrics(testbed.AS_OF, testbed.DURATION_BUCKETS))]

    before = answers()
    assert store.compact(dt.date(2024, 1, 20)) > 10
    assert answers() == before
    assert store.compact(dt.date(2024, 1, 20)) == 0
    days = {p.name: len(list(p.glob("batch=*")))
            for p in (tmp_path / "s" / "table=login_events").glob("event_date=*")}
    assert all(n == 1 for day, n in days.items() if day < "event_date=2024-01-20")
    assert any(n == 2 for day, n in days.items() if day >= "event_date=2024-01-20")
    # The batch that the joined files stand for can still be repeated for open dates.
    store.append(raw.filter("event_id < 0"), 7, default_time=stamp())
    assert answers() == before


def test_history_of_an_absent_user_reads_no_row_group(spark, tmp_path):
    """Between the ends of every row group, and beyond what dictionaries could tell."""
    target = EventStore(spark, str(tmp_path))
    rows = spark.range(80_000).selectExpr(
        "id AS event_id", "sha2(CAST(id AS STRING), 256) AS user_id", "'login_events' AS table",
        "date'2024-01-01' AS event_date")
    missing = [f for f in STORE_SCHEMA.fields if f.name not in (*rows.columns, "batch")]
    rows = rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})
    target.append_rows(rows.repartition(2), 0)

    def scanned(user):
        found = target.login_events().filter(F.col("user_id") == user)
        found.collect()
        plan = found._jdf.queryExecution().executedPlan()
        scan = plan.collectLeaves().head()
        return found.count(), scan.metrics().apply("numOutputRows").value()

    assert scanned("8" * 64) == (0, 0)
    spark.conf.set("parquet.filter.bloom.enabled", "false")
    try:
        assert scanned("8" * 64)[1] > 0
    finally:
        spark.conf.unset("parquet.filter.bloom.enabled")


class Died(Exception):
    pass


@pytest.mark.parametrize("after", [False, True])
def test_compaction_survives_a_crash_at_any_step(spark, tmp_path, monkeypatch, after):
    """The driver dies before or after each file operation; no row is lost or doubled."""
    day = dt.date(2024, 1, 1)
    rows = spark.createDataFrame(
        [(i, f"u{i}", "login_events", day) for i in range(12)],
        "event_id long, user_id string, table string, event_date date")
    missing = [f for f in STORE_SCHEMA.fields if f.name not in (*rows.columns, "batch")]
    rows = rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})
    wanted = list(range(12))
    steps = 0
    for step in range(30):
        target = EventStore(spark, str(tmp_path / f"{after}{step}"))
        for batch in range(3):
            target.append_rows(rows.filter(f"event_id % 3 = {batch}"), batch)
        calls = 0

        def dying(work):
            def run(*args, **kwargs):
                nonlocal calls
                calls += 1
                if calls - 1 == step and not after:
                    raise Died
                found = work(*args, **kwargs)
                if calls - 1 == step:
                    raise Died
                return found
            return run

        def ids():
            return sorted(r[0] for r in target.rows("login_events").select("event_id").collect())

        with monkeypatch.context() as patched:
            for name in ("write_text", "remove_folder"):
                patched.setattr(store_module, name, dying(getattr(store_module, name)))
            patched.setattr(DataFrameWriter, "parquet", dying(DataFrameWriter.parquet))
            try:
                target.compact(dt.date(2024, 1, 2))
            except Died:
                steps += 1
            else:
                break
        assert ids() == wanted
        target.compact(dt.date(2024, 1, 2))
        assert ids() == wanted
        assert target.compact(dt.date(2024, 1, 2)) == 0
        folder = tmp_path / f"{after}{step}"
        assert len(list(folder.glob("table=*/event_date=*/batch=*"))) == 1
        assert not list(folder.glob("_compaction/*.begun")) + list(folder.glob("_compaction/*.ended"))
        # Joining goes on where a new batch comes for the date.
        target.append_rows(rows.withColumn("event_id", F.col("event_id") + 100), 9)
        assert target.compact(dt.date(2024, 1, 2)) == 1
        assert ids() == [*wanted, *range(100, 112)]
    assert steps >= 8


def test_a_note_that_was_not_finished_counts_for_nothing(spark, raw, tmp_path):
    target = filled(EventStore(spark, str(tmp_path)), raw)
    before = rows_of(target.rows("login_events"))
    write_text(spark, f"{tmp_path}/_compaction/table=login_events.event_date=2024-01-01.ended", "{")
    assert rows_of(target.rows("login_events")) == before


def test_event_id_from_partition_and_offset(spark):
    df = spark.createDataFrame([(0, 7), (1, 7), (1, 8)], "partition int, offset long")
    ids = [r["event_id"] for r in store_module.with_event_id(df).collect()]
    assert len(set(ids)) == 3 and ids[1] + 1 == ids[2]


def test_shared_folder_without_a_setting_is_below_the_warehouse(spark):
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    conf = SimpleNamespace(get=lambda key, *default: {
        "spark.sql.warehouse.dir": warehouse}.get(key, *default))
    session = SimpleNamespace(conf=conf, _jvm=spark._jvm, _jsc=spark._jsc)
    assert shared_folder(session).startswith(warehouse)


def test_shared_folder_is_below_the_session_setting(spark):
    folder = shared_folder(spark)
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert folder != shared_folder(spark)
