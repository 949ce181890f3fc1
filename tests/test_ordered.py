"""Ordered rows on a stream against the lag over all rows; sinks, progress, sketches."""

import datetime as dt
import random

import pytest
from conftest import SMALL, rows_of
from pyspark.sql import functions as F

from gatewatch.operators import metrics, sessions
from gatewatch.operators.skew import lag_by_key
from gatewatch.plans import testbed
from gatewatch.sources.files import parquet_stream
from gatewatch.sources.folders import sub_folders
from gatewatch.streaming import gauges, jobs
from gatewatch.streaming.ordered import lag_stream, tick, tick_stream
from gatewatch.streaming.sinks import bucket_count, changes_sink, date_bucket, read_changes

START = dt.datetime(2024, 1, 1)
END = dt.datetime(2025, 1, 1)
SCHEMA = ("event_id long, user_id string, event_time timestamp, event_type string, "
          "device_type string, success boolean, amount double, seen timestamp")


def rows_for(seed, n=240):
    """A third of the rows are one user's; ties in time, nulls in every column."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        user = "hot" if rng.random() < 0.35 else rng.choice(["a", "b", "c", 'q"\\é', None])
        at = START + dt.timedelta(seconds=rng.randrange(0, 900), microseconds=rng.choice([0, 1, 7]))
        out.append((i, user, rng.choice([at, at, at, None]) if i % 20 == 0 else at,
                    rng.choice(["login", "logout"]), rng.choice(["web", None]),
                    rng.choice([True, True, None]), rng.choice([0.1, 1e300, None]),
                    rng.choice([at, None])))
    return out


def drained(spark, base, name, make, files, **options):
    """Start the query once per group of files, then tell it that no more is to come."""
    inbox = f"{base}/inbox-{name}"
    spark.createDataFrame([], SCHEMA).write.mode("append").parquet(inbox)
    for k, rows in enumerate([*files, None]):
        if rows is None:
            tick(spark, f"{base}/ticks-{name}", END)
        else:
            spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(inbox)
        live = parquet_stream(spark, inbox, SCHEMA, 1)
        ticks = tick_stream(spark, f"{base}/ticks-{name}")
        jobs.start_appended(make(live, ticks), name, base, None, 4).awaitTermination()
    return spark.read.parquet(f"{base}/{name}")


@pytest.mark.parametrize("offset", [1, 3])
def test_lag_on_a_stream_equals_the_lag_over_all_rows(spark, base, offset):
    rows = rows_for(offset)
    random.Random(9).shuffle(rows)
    lags = {"prev_time": "event_time", "prev_seen": "seen", "prev_amount": "amount"}
    order = ["event_time", "event_id"]
    got = drained(spark, base, "lagged", lambda live, ticks: lag_stream(
        live, "user_id", order, lags, offset, delay="1 hour", ticks=ticks),
        [rows[:80], rows[80:81], rows[81:]])
    whole = spark.createDataFrame(rows, SCHEMA).filter("user_id IS NOT NULL AND event_time IS NOT NULL")
    wanted = lag_by_key(whole, "user_id", order, lags, offset)
    assert got.columns == wanted.columns and got.dtypes == wanted.dtypes
    assert rows_of(got) == rows_of(wanted)


def test_silent_keys_are_forgotten(spark, base):
    """A login of long ago no longer counts once its user was silent for the span."""
    def row(i, user, minutes, kind):
        return (i, user, START + dt.timedelta(minutes=minutes), kind, "web", True, None, None)

    files = [[row(0, "a", 0, "login"), row(1, "b", 0, "login")],
             [row(2, "b", 30, "login"), row(3, "c", 300, "login")],
             [row(4, "c", 301, "logout")],
             [row(5, "a", 400, "logout"), row(6, "b", 401, "logout"), row(7, "c", 402, "logout")]]
    for keep, wanted in ((3600, {4: 60.0, 5: None, 6: None, 7: None}),
                         (None, {4: 60.0, 5: 24000.0, 6: 22260.0, 7: None})):
        got = drained(spark, base, f"kept{keep}", lambda live, ticks: sessions.session_durations(
            live, lag=lambda *a: lag_stream(*a, delay="1 minute", ticks=ticks,
                                            keep_seconds=keep)), files)
        assert {r["event_id"]: r["session_duration"] for r in got.collect()} == wanted


def test_histogram_of_durations_in_one_query(spark, base):
    rows = rows_for(5)
    inbox = f"{base}/inbox"
    spark.createDataFrame(rows[:100], SCHEMA).coalesce(1).write.mode("append").parquet(inbox)
    bounds = (10.0, 60.0, 300.0)
    for last in (False, True):
        if last:
            spark.createDataFrame(rows[100:], SCHEMA).coalesce(1).write.mode("append").parquet(inbox)
        query = jobs.start_duration_histogram(
            parquet_stream(spark, inbox, SCHEMA, 1), base, bounds, None, 4, "1 hour",
            tick_stream(spark, f"{base}/ticks"))
        query.awaitTermination()
    tick(spark, f"{base}/ticks", END)
    jobs.start_duration_histogram(
        parquet_stream(spark, inbox, SCHEMA, 1), base, bounds, None, 4, "1 hour",
        tick_stream(spark, f"{base}/ticks")).awaitTermination()
    whole = sessions.session_durations(spark.createDataFrame(rows, SCHEMA))
    assert rows_of(jobs.read_duration_histogram(spark, base, bounds)) == rows_of(
        metrics.histogram(whole, "session_duration", ["device_type"], bounds))


def test_many_rows_of_a_date_are_written_by_several_tasks(spark, base):
    """Also with the date as bucket; few rows stay together."""
    rows = spark.range(60_000).selectExpr(
        "timestamp'2024-01-05 00:00:00' + make_dt_interval(0, 0, 0, id) AS window_start",
        "sha2(CAST(id AS STRING), 256) AS user_id", "id AS failures")
    keys = ["window_start", "user_id"]
    sink = changes_sink(base, keys, bucket=date_bucket("window_start"))
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(advisory)
    spark.conf.set(advisory, "256k")
    try:
        sink(rows, 0)
    finally:
        spark.conf.set(advisory, before)
    sink(rows.limit(10).withColumn("failures", F.lit(7)), 1)

    def files(epoch):
        return spark.read.parquet(f"{base}/epoch={epoch}").inputFiles()

    assert sub_folders(spark, f"{base}/epoch=0") == ["bucket=2024-01-05"]
    assert len(files(0)) > 2 and len(files(1)) == 1
    got = read_changes(spark, base, keys)
    assert got.count() == 60_000 and got.filter("failures = 7").count() >= 10


def test_buckets_follow_the_cluster_and_stay(spark, base):
    sink = changes_sink(f"{base}/new", ["k"])
    sink(spark.range(1000).selectExpr("id AS k", "id AS n"), 0)
    assert bucket_count(spark, f"{base}/new") == spark.sparkContext.defaultParallelism
    assert len(sub_folders(spark, f"{base}/new/epoch=0")) == spark.sparkContext.defaultParallelism
    # A folder of before the number was noted.
    spark.range(3).write.parquet(f"{base}/old/epoch=0")
    assert bucket_count(spark, f"{base}/old") == 64 == bucket_count(spark, f"{base}/old")


def test_running_sessions_by_day_with_late_rows(spark, events, base):
    ordered = events.filter("event_id % 10 <> 3")
    late = events.filter("event_id % 10 = 3")
    inbox = f"{base}/inbox"
    for part in (ordered, late):
        part.coalesce(1).write.mode("append").parquet(inbox)
        gauges.start_running_sessions(parquet_stream(spark, inbox, events.schema, 1), base, None,
                                      4).awaitTermination()
    wanted = sessions.active_sessions_trend(events)
    assert rows_of(gauges.read_running_sessions(spark, base)) == rows_of(wanted)
    first, last = dt.date(2024, 1, 9), dt.date(2024, 1, 12)
    some = gauges.read_running_sessions(spark, base, first, last)
    assert rows_of(some) == rows_of(wanted.filter(
        "to_date(window_start) BETWEEN date'2024-01-09' AND date'2024-01-12'"))
    read = {f.split("bucket=")[1].split("/")[0] for f in some.inputFiles()}
    assert {b for b in read if b.startswith("hour-")} == {
        f"hour-2024-01-{d:02d}" for d in range(9, 13)}


def test_sketches_are_close_and_add_up(spark, base):
    """100,000 devices over three hours, two thirds of them seen in two hours."""
    rows = spark.range(100_000).selectExpr(
        "id AS event_id", "'login' AS event_type", "'web' AS device_type",
        "concat('device-', id) AS device_id", "inline(array(struct(0 AS h), struct(id % 3 AS h)))")
    rows = rows.selectExpr("*", "timestamp'2024-01-01 00:00:00' + make_dt_interval(0, h) AS event_time")
    inbox = f"{base}/inbox"
    rows.coalesce(2).write.parquet(inbox)
    live = parquet_stream(spark, inbox, rows.schema, 1)
    gauges.start_device_sketches(live, base, None, 4).awaitTermination()

    def found(*span):
        return gauges.read_unique_devices(spark, base, *span).first()["unique_devices"]

    assert abs(found() - 100_000) < 2_000
    assert abs(found(dt.datetime(2024, 1, 1, 1), dt.datetime(2024, 1, 1, 2)) - 33_333) < 700
    assert abs(found(dt.datetime(2024, 1, 1, 1)) - 66_666) < 1_400
    size = spark.read.parquet(f"{base}/device_sketches").selectExpr("max(length(sketch))").first()[0]
    assert size < 40_000  # however many devices


def test_every_epoch_is_in_the_progress_table_after_a_restart(spark, base):
    inbox = f"{base}/inbox"
    testbed.raw_events(spark, SMALL).repartition(5).write.parquet(inbox)
    for session in range(2):
        log = jobs.log_progress(spark, base)
        try:
            live = testbed.to_login_events(parquet_stream(spark, inbox, testbed.EVENTS_SCHEMA, 1))
            query = jobs.start_session_counters(live, base, None)
            query.awaitTermination()
            spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        finally:
            spark.streams.removeListener(log)
        testbed.raw_events(spark, SMALL).limit(20).coalesce(1).write.mode("append").parquet(inbox)
    rows = jobs.read_progress(spark, base).filter("query = 'session_counters'").collect()
    assert sorted({r["batchId"] for r in rows if r["numInputRows"]}) == [0, 1, 2, 3, 4, 5]
    assert sum(r["numInputRows"] for r in rows) == 1020
    assert all(r["seconds"] > 0 for r in rows if r["numInputRows"])


@pytest.mark.parametrize("keep", [None, 600])
def test_many_users_share_few_entries_of_the_state(spark, base, keep):
    """As many looks into the state as buckets, however many users; lags as over all rows."""
    rows = [(i, f"user-{i * 7 % 400}", START + dt.timedelta(seconds=i // 3), "login", "web", True,
             None, None) for i in range(1600)]
    inbox, lags, entries = f"{base}/inbox", {"prev_id": "event_id", "prev_time": "event_time"}, []
    for part in (rows[:900], rows[900:], None):
        if part is None:
            tick(spark, f"{base}/ticks", START + dt.timedelta(minutes=25))
        else:
            spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(inbox)
        query = jobs.start_appended(lag_stream(
            parquet_stream(spark, inbox, SCHEMA, 1), "user_id", ["event_time", "event_id"], lags,
            delay="1 minute", ticks=tick_stream(spark, f"{base}/ticks"), keep_seconds=keep,
            buckets=16), "lagged", base, None, 4)
        query.awaitTermination()
        entries += [op["numRowsTotal"] for p in query.recentProgress for op in p["stateOperators"]
                    if op["operatorName"].startswith("transformWithState")]
    assert max(entries) == 16
    whole = lag_by_key(spark.createDataFrame(rows, SCHEMA), "user_id", ["event_time", "event_id"],
                       lags)
    assert rows_of(spark.read.parquet(f"{base}/lagged")) == rows_of(whole)
