"""Streams: several files, restarts, repeated epochs, late rows."""

import datetime as dt
import json
import shutil
import threading
import time
from pathlib import Path

import pandas as pd
import pytest
from conftest import SMALL, rows_of
from pyspark.sql import functions as F

from gatewatch import run
from gatewatch.operators import (
    ingest,
    metrics,
    rates,
    rules,
    sessions,
    store_queries,
    users,
)
from gatewatch.plans import testbed
from gatewatch.sources.files import parquet_stream
from gatewatch.sources.folders import complete_versions, sub_folders
from gatewatch.sources.store import EventStore
from gatewatch.streaming import gauges, jobs
from gatewatch.streaming.ordered import tick, tick_stream
from gatewatch.streaming.sinks import (
    changes_sink,
    read_changes,
    read_snapshot,
    snapshot_sink,
)

CUTS = (0, 300, 301, 700, 1000)


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    """The events table as files in time order, ready to be copied one by one."""
    folder = tmp_path_factory.mktemp("parts")
    table = pd.read_parquet(f"{SMALL}/events.parquet").sort_values("ts")
    names = []
    for i, (a, b) in enumerate(zip(CUTS, CUTS[1:])):
        name = folder / f"{i}.parquet"
        table.iloc[a:b].to_parquet(name, coerce_timestamps="us", index=False)
        names.append(name)
    return names


@pytest.fixture
def inbox(tmp_path):
    folder = tmp_path / "inbox"
    folder.mkdir()
    return folder


def stream(spark, inbox):
    schema = testbed.raw_events(spark, SMALL).schema
    return testbed.to_login_events(parquet_stream(spark, str(inbox), schema, 1))


def deliver(parts, inbox, *numbers):
    for i in numbers:
        shutil.copy(parts[i], inbox / f"part-{i}.parquet")


def test_five_queries_over_restarts(spark, events, parts, inbox, base):
    for numbers in ((0, 1), (2,), (3,)):
        deliver(parts, inbox, *numbers)
        jobs.await_each(jobs.start_rate_tables(stream(spark, inbox), base, drain=True))
    for name in jobs.TRIGGERS:
        assert rows_of(read_snapshot(spark, f"{base}/{name}")) == rows_of(
            jobs.rate_table(events, name))
        assert len(complete_versions(spark, f"{base}/{name}", "epoch")) == 3


def test_shared_query_gives_the_five_tables(spark, events, parts, inbox, base):
    for numbers in ((0, 1), (2, 3)):
        deliver(parts, inbox, *numbers)
        query = jobs.start_shared_rate_tables(stream(spark, inbox), base, None)
        query.awaitTermination()
    assert len(jobs.batch_seconds(query)) > 0
    for name in jobs.TRIGGERS:
        assert rows_of(read_snapshot(spark, f"{base}/{name}")) == rows_of(
            jobs.rate_table(events, name))


def test_counters_and_profiles_and_trend(spark, events, parts, inbox, base):
    for numbers in ((0,), (1, 2), (3,)):
        deliver(parts, inbox, *numbers)
        live = stream(spark, inbox)
        jobs.await_each([
            jobs.start_session_counters(live, base, None),
            jobs.start_active_sessions_by_device(live, base, None),
            jobs.start_user_profiles(live, base, None),
            jobs.start_activity_trend(live, base, every=None),
        ])
    assert rows_of(read_snapshot(spark, f"{base}/session_counters")) == rows_of(
        metrics.session_counters(events))
    assert rows_of(read_snapshot(spark, f"{base}/active_sessions_by_device")) == rows_of(
        metrics.counter(events, "active_sessions_by_device"))
    assert rows_of(read_changes(spark, f"{base}/user_profiles", jobs.PROFILE_KEYS)) == rows_of(
        users.user_profiles(events))
    assert rows_of(read_changes(spark, f"{base}/activity_trend", jobs.TREND_KEYS)) == rows_of(
        sessions.activity_trend(events))


def test_processing_time_trigger_and_await(spark, parts, inbox, base):
    """A query with a trigger takes files as they come and runs until it is stopped."""
    spark.streams.resetTerminated()
    deliver(parts, inbox, 0)
    query = jobs.start_session_counters(stream(spark, inbox), base, "500 milliseconds")
    for number in (1, 2):
        seen = len(jobs.batch_seconds(query))
        deliver(parts, inbox, number)
        while len(jobs.batch_seconds(query)) <= seen:
            time.sleep(0.1)
    query.processAllAvailable()
    threading.Timer(0.5, query.stop).start()
    jobs.await_any(spark)
    assert not query.isActive
    assert all(seconds > 0 for _, seconds in jobs.batch_seconds(query))
    part = testbed.to_login_events(
        spark.read.schema(testbed.EVENTS_SCHEMA).parquet(str(inbox)))
    assert rows_of(read_snapshot(spark, f"{base}/session_counters")) == rows_of(
        metrics.session_counters(part))


END = dt.datetime(2024, 4, 1)


def test_session_durations_over_restarts(spark, events, parts, inbox, base):
    for numbers in ((0, 1), (2,), (3,), ()):
        deliver(parts, inbox, *numbers)
        if not numbers:
            tick(spark, f"{base}/ticks", END)
        jobs.start_session_durations(
            stream(spark, inbox), base, None,
            ticks=tick_stream(spark, f"{base}/ticks")).awaitTermination()
    got = jobs.read_session_durations(spark, base)
    assert rows_of(got.filter("NOT late").drop("late")) == rows_of(
        sessions.session_durations(events))


def test_files_out_of_order_lose_nothing(spark, events, parts, inbox, base):
    """Within the delay logouts are paired and events count, whatever the order of files."""
    for number in (2, 0, 3, 1, None):
        if number is None:
            tick(spark, f"{base}/ticks", END)
        else:
            deliver(parts, inbox, number)
        live = stream(spark, inbox)
        jobs.await_each([
            jobs.start_session_durations(live, base, None, delay="60 days",
                                         ticks=tick_stream(spark, f"{base}/ticks")),
            jobs.start_activity_trend(live, base, every=None),
            jobs.start_failed_windows(live, base, every=None)])
    got = jobs.read_session_durations(spark, base)
    assert got.filter("late").count() == 0
    assert rows_of(got.drop("late")) == rows_of(sessions.session_durations(events))
    assert rows_of(read_changes(spark, f"{base}/activity_trend", jobs.TREND_KEYS)) == rows_of(
        sessions.activity_trend(events))
    assert rows_of(read_changes(spark, f"{base}/failed_windows", jobs.FAILED_WINDOW_KEYS)) == (
        rows_of(rules.failed_windows(events)))


def test_rows_behind_the_watermark_are_kept_and_folded_in(spark, events, parts, inbox, base):
    """What a short delay leaves out lies in a side table; folding gives the batch results."""
    for number in (2, 0, 3, 1, None):
        if number is None:
            tick(spark, f"{base}/ticks", END)
        else:
            deliver(parts, inbox, number)
        live = stream(spark, inbox)
        queries = [
            jobs.start_session_durations(live, base, None, delay="1 minute",
                                         ticks=tick_stream(spark, f"{base}/ticks")),
            jobs.start_activity_trend(live, base, watermark="1 minute", every=None)]
        if number != 0:  # the side table may lag behind and take several files later
            queries.append(jobs.start_late_rows(live, base, "1 minute", None))
        jobs.await_each(queries)
    trend, durations = sessions.activity_trend(events), sessions.session_durations(events)
    assert rows_of(jobs.read_trend(spark, base)) != rows_of(trend)
    assert jobs.read_session_durations(spark, base).count() < durations.count()
    assert 0 < jobs.read_late_rows(spark, base).count() < events.count()
    for _ in range(2):  # folding again changes nothing
        jobs.fold_late_trend(spark, base, events.withColumn("event_date", F.to_date("event_time")))
        jobs.fold_late_durations(spark, base, events)
        assert rows_of(jobs.read_trend(spark, base)) == rows_of(trend)
        got = jobs.read_session_durations(spark, base)
        assert rows_of(got.drop("late")) == rows_of(durations)
        assert got.filter("late").count() > 0 and got.filter("NOT late").count() > 0


def test_a_named_watermark_counts_what_it_drops(spark, parts, inbox, base):
    dropped = 0
    for number in (3, 0):
        deliver(parts, inbox, number)
        query = jobs.start_activity_trend(stream(spark, inbox), base, watermark="1 minute",
                                          every=None)
        query.awaitTermination()
        dropped += jobs.dropped_rows(query)
    assert dropped > 0


def test_poison_does_not_stop_the_store(spark, inbox, base):
    good = {"event_type": "logout", "user_id": "u", "device_info": {}, "timestamp": 1704067200000}
    rows = [(i, json.dumps({**good, "timestamp": t}))
            for i, t in enumerate([99999999999999999, 1704067200000000000, 1704067200000])]
    spark.createDataFrame(rows, "event_id long, value string").coalesce(1).write.mode(
        "append").parquet(str(inbox))
    store = EventStore(spark, f"{base}/store")
    messages = parquet_stream(spark, str(inbox), "event_id long, value string")
    jobs.start_store(messages, store, base, None).awaitTermination()
    assert store.login_events().count() == 1
    assert {r["error_type"] for r in store.system_errors().collect()} == {"bad_timestamp"}
    assert store.system_errors().count() == 2


def test_gauges_over_restarts(spark, events, parts, inbox, base):
    stored = ingest.storable(events)
    seen = None
    for count, numbers in ((1, (0,)), (3, (1, 2)), (4, (3,))):
        deliver(parts, inbox, *numbers)
        jobs.await_each(gauges.start_gauges(ingest.storable(stream(spark, inbox)), base, None))
        part = spark.read.schema(testbed.EVENTS_SCHEMA).parquet(str(inbox))
        seen = ingest.storable(testbed.to_login_events(part))
        active = store_queries.active_sessions(seen, columns=metrics.ACTIVE_COLUMNS)
        got = {(r["metric"], tuple(sorted(r["labels"].items()))): r["value"]
               for r in gauges.read_gauges(spark, base, dt.datetime(2024, 1, 31)).collect()}
        for row in metrics.active_by_device(active).collect():
            label = (("device_type", row["device_type"]),)
            assert got["active_sessions_current", label] == row["active_sessions"]
            assert got["unique_devices_active", label] == row["unique_devices"]
        assert got["concurrent_users_current", (("user_type", "total"),)] == active.count()
        alerts = store_queries.recent_failures(seen, testbed.AS_OF).collect()
        assert sum(v for (m, _), v in got.items() if m == "security_alerts_current") == sum(
            r["count"] for r in alerts)
    assert seen.count() == stored.count()


def test_decoded_stream_feeds_the_rate_tables(spark, inbox, base):
    raw = testbed.raw_messages(spark, SMALL)
    raw.coalesce(1).write.mode("append").parquet(str(inbox))
    messages = parquet_stream(spark, str(inbox), raw.schema)
    jobs.start_rate_table(jobs.decoded_events(messages), "city_metrics", base,
                          None).awaitTermination()
    flat = ingest.flatten(ingest.with_event_time(ingest.decode(raw)))
    assert rows_of(read_snapshot(spark, f"{base}/city_metrics")) == rows_of(
        rates.login_rates(flat, ["city"]))


def test_store_ingestion_stream(spark, inbox, base):
    raw = testbed.raw_messages(spark, SMALL)
    raw.repartition(3).write.mode("append").parquet(str(inbox))
    store = EventStore(spark, f"{base}/store")
    messages = parquet_stream(spark, str(inbox), raw.schema, 1)
    jobs.start_store(messages, store, base, None).awaitTermination()
    assert rows_of(store.system_errors().select("event_id")) == rows_of(
        ingest.dead_letters(raw).select("event_id"))
    assert rows_of(store.login_events().select("event_id")) == rows_of(
        ingest.valid_events(raw).filter("event_type IN ('login', 'logout')").select("event_id"))


def test_entry_points_on_kafka_shaped_messages(spark, inbox, base):
    raw = testbed.raw_messages(spark, SMALL)
    kafka_like = testbed.kafka_rows(raw).drop("event_id")
    kafka_like.coalesce(1).write.mode("append").parquet(str(inbox))
    messages = ingest.envelope(parquet_stream(spark, str(inbox), kafka_like.schema))
    jobs.await_each(run.start_analytics(messages, f"{base}/a", shared=False, drain=True))
    jobs.await_each(run.start_analytics(messages, f"{base}/b", drain=True))
    for name in jobs.TRIGGERS:
        assert (rows_of(read_snapshot(spark, f"{base}/a/{name}"))
                == rows_of(read_snapshot(spark, f"{base}/b/{name}")))
    jobs.await_each(run.start_monitoring(messages, base, drain=True))
    store = EventStore(spark, f"{base}/store")
    columns = ["user_id", "event_time", "device_id"]
    assert (rows_of(jobs.read_active_sessions(spark, base).select(columns))
            == rows_of(store.active_sessions().select(columns)))
    table = read_changes(spark, f"{base}/users_table", jobs.USERS_KEYS)
    assert rows_of(table) == rows_of(store.users())
    errors = read_snapshot(spark, f"{base}/errors_total")
    assert rows_of(errors) == rows_of(metrics.errors_total(store.system_errors()))
    assert rows_of(jobs.read_user_status(spark, base)) == rows_of(users.user_status(store.users()))
    assert rows_of(gauges.read_running_sessions(spark, base)) == rows_of(
        sessions.active_sessions_trend(store.login_events()))
    tick(spark, f"{base}/ticks", dt.datetime(2100, 1, 1))
    jobs.await_each(run.start_monitoring(messages, base, drain=True))
    wanted = sessions.session_durations(store.login_events())
    assert rows_of(jobs.read_session_durations(spark, base).drop("late")) == rows_of(wanted)
    assert rows_of(jobs.read_duration_histogram(spark, base, run.DURATION_BUCKETS)) == rows_of(
        metrics.histogram(wanted, "session_duration", ["device_type"], run.DURATION_BUCKETS))
    for name, rule in jobs.RULES.items():
        found, marked = spark.read.parquet(f"{base}/{name}"), rule(store.login_events())
        assert rows_of(found.select("event_id")) == rows_of(marked.select("event_id"))
    samples = read_snapshot(spark, f"{base}/counters")
    flat = ingest.flatten(ingest.with_event_time(ingest.decode(raw)))
    logins = samples.filter("metric = 'login_events_total'").first()["value"]
    assert logins == flat.filter("event_type = 'login'").count()


def numbers(spark, *rows):
    return spark.createDataFrame(list(rows), "k string, n long")


def test_snapshot_is_replaced_also_by_an_empty_one(spark, base):
    sink = snapshot_sink(base, keep=2)
    sink(numbers(spark, ("a", 1)), 0)
    sink(numbers(spark, ("a", 2)), 1)
    sink(numbers(spark, ("a", 2)), 1)
    assert rows_of(read_snapshot(spark, base)) == rows_of(numbers(spark, ("a", 2)))
    sink(numbers(spark, ("a", 2)).filter("n > 2"), 2)
    assert read_snapshot(spark, base).count() == 0
    assert complete_versions(spark, base, "epoch") == [1, 2]


def test_unfinished_version_is_not_read(spark, base):
    sink = snapshot_sink(base)
    sink(numbers(spark, ("a", 1)), 0)
    sink(numbers(spark, ("a", 2)), 1)
    Path(f"{base}/epoch=1/_SUCCESS").unlink()
    assert rows_of(read_snapshot(spark, base)) == rows_of(numbers(spark, ("a", 1)))


def test_changes_are_merged_and_repeatable(spark, base):
    sink = changes_sink(base, ["k"], merge_every=2)
    sink(numbers(spark, ("a", 1), ("b", 1)), 0)
    for epoch in range(1, 8):
        batch = numbers(spark, ("a", epoch * 10), (f"c{epoch}", epoch))
        sink(batch, epoch)
        sink(batch, epoch)  # repeated after a failure
    expected = numbers(spark, ("a", 70), ("b", 1), *[(f"c{e}", e) for e in range(1, 8)])
    assert rows_of(read_changes(spark, base, ["k"])) == rows_of(expected)
    assert complete_versions(spark, base, "epoch")[0] > 2
    before = numbers(spark, ("a", 60), ("b", 1), *[(f"c{e}", e) for e in range(1, 7)])
    assert rows_of(read_changes(spark, base, ["k"], until=6)) == rows_of(before)


def test_only_changed_buckets_are_written_again(spark, base):
    sink = changes_sink(base, ["k"], merge_every=2, bucket=F.substring("k", 1, 1))
    sink(numbers(spark, ("a1", 1), ("b1", 1), ("c1", 1)), 0)
    sink(numbers(spark, ("a2", 1)), 1)
    sink(numbers(spark, ("b2", 2)), 2)
    assert sub_folders(spark, f"{base}/base=2") == ["bucket=a", "bucket=b", "bucket=c"]
    sink(numbers(spark, ("a1", 3)), 3)
    sink(numbers(spark, ("a1", 4)), 4)
    assert sub_folders(spark, f"{base}/base=4") == ["bucket=a"]
    sink(numbers(spark, ("a1", 5)), 5)
    sink(numbers(spark, ("a3", 6)), 6)
    # What is covered goes, and only that.
    assert "bucket=a" not in sub_folders(spark, f"{base}/base=2")
    assert rows_of(read_changes(spark, base, ["k"])) == rows_of(numbers(
        spark, ("a1", 5), ("a2", 1), ("a3", 6), ("b1", 1), ("b2", 2), ("c1", 1)))
    assert rows_of(read_changes(spark, base, ["k"], ["b"])) == rows_of(
        numbers(spark, ("b1", 1), ("b2", 2)))
    assert read_changes(spark, base, ["k"], ["z"]).count() == 0


def test_epochs_without_rows(spark, base):
    sink = changes_sink(base, ["k"], merge_every=2)
    none = numbers(spark, ("a", 1)).filter("n > 1")
    with pytest.raises(FileNotFoundError):
        read_changes(spark, base, ["k"])
    sink(none, 0)
    assert read_changes(spark, base, ["k"], like=none).count() == 0
    for epoch in (1, 2):
        sink(none, epoch)
    sink(numbers(spark, ("a", 3)), 3)
    sink(none, 4)
    assert rows_of(read_changes(spark, base, ["k"])) == rows_of(numbers(spark, ("a", 3)))


def test_gauge_sink_repeats_and_empty_batches(spark, events, base):
    """The counts per device follow the latest rows, epoch by epoch."""
    stored = ingest.storable(events)
    sink = gauges.device_sessions_sink(base)
    cuts = ["event_id < 0", "event_id < 200", "event_id < 600", "event_id < 0", "event_id >= 0"]
    for epoch, cut in enumerate(cuts):
        seen = stored.filter(cut)
        latest = store_queries.latest_session_rows(seen, jobs.SESSION_COLUMNS)
        sink(latest, epoch)
        sink(latest, epoch)  # repeated
    got = read_changes(spark, f"{base}/device_sessions", gauges.DEVICE_KEYS).filter("n <> 0")
    active = store_queries.active_sessions(stored, columns=jobs.SESSION_COLUMNS)
    assert rows_of(got) == rows_of(active.groupBy(*gauges.DEVICE_KEYS).agg(
        F.count(F.lit(1)).alias("n")))


def test_a_repeated_epoch_leaves_what_was_committed(spark, base):
    sink = snapshot_sink(base)
    sink(numbers(spark, ("a", 1)), 0)
    files = sorted(p.name for p in Path(f"{base}/epoch=0").iterdir())
    sink(numbers(spark, ("a", 1)), 0)
    assert sorted(p.name for p in Path(f"{base}/epoch=0").iterdir()) == files


def test_stream_column_names_match_batch(spark, parts, inbox):
    deliver(parts, inbox, 0)
    live = stream(spark, inbox)
    assert live.isStreaming
    assert jobs.rate_table(live, "combo_metrics").columns == rates.login_rates(
        testbed.login_events(spark, SMALL), rates.COMBO_KEYS).columns


def test_slices_of_a_larger_table_have_a_file_for_each_core(spark, tmp_path, monkeypatch):
    """Each micro-batch takes one slice: all its files, and times behind those before."""
    assert testbed.slice_sizes(100_000, 8) == (6, 1)
    assert testbed.slice_sizes(6_000_000, 12) == (6, 12)
    assert testbed.slice_sizes(36_000_000, 12) == (12, 12)
    testbed.raw_events(spark, SMALL).write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(testbed, "LEAST_ROWS", 20)
    for mixed in (False, True):
        folder, files = testbed.event_slices(spark, str(tmp_path), mixed)
        assert files == 8
        seen = {}
        live = parquet_stream(spark, folder, testbed.EVENTS_SCHEMA, files)
        live.writeStream.trigger(availableNow=True).foreachBatch(lambda df, epoch: seen.update(
            {epoch: (df.rdd.getNumPartitions(), df.agg(F.count("*"), F.min("ts"), F.max("ts")).first())}
        )).option("checkpointLocation", str(tmp_path / f"checkpoint-{mixed}")).start().awaitTermination()
        assert [n for n, _ in seen.values()] == [8] * 6
        assert sum(rows[0] for _, rows in seen.values()) == 1000
        spans = [rows[1:] for _, rows in seen.values()]
        in_time = sorted(spans)
        assert spans == (in_time[1::2] + in_time[::2] if mixed else in_time)
        assert all(a[1] <= b[0] for a, b in zip(in_time, in_time[1:]))
