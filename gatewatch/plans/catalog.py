"""Registered queries: every operator run over the whole given tables.

Outputs are flat and use zone-less timestamps so that they can be compared with
a SQL engine.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from datetime import date, datetime, timedelta
from threading import Timer

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

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
from gatewatch.schema import LOGIN, LOGOUT, REGISTRATION, SUSPICIOUS
from gatewatch.sources.files import parquet_stream
from gatewatch.sources.folders import shared_folder
from gatewatch.sources.store import EventStore, with_event_id
from gatewatch.streaming import gauges, jobs
from gatewatch.streaming.ordered import tick, tick_stream
from gatewatch.streaming.sinks import read_changes, read_snapshot

Query = Callable[[SparkSession, str], DataFrame]

HISTORY_USER = "user_7"
HISTORY_START = "2024-01-08 00:00:00"
HISTORY_END = "2024-01-20 12:00:00"
DEFAULT_TIME = "2024-01-31 00:00:00"


def plain(column: str | Column, name: str | None = None) -> Column:
    column_ = F.col(column) if isinstance(column, str) else column
    return column_.cast("timestamp_ntz").alias(name or column)


def _on_events(fn: Callable[[DataFrame], DataFrame], *kinds: str, k: bool = True) -> Query:
    """Run over the mapped events; ``kinds`` are those that ``fn`` looks at, and ``k``
    says whether it looks at columns that come from the JSON."""
    return lambda spark, sf_dir: fn(testbed.login_events(spark, sf_dir, *kinds, k_once=k))


def _on_stored(fn: Callable[[DataFrame], DataFrame], *kinds: str, k: bool = True) -> Query:
    return lambda spark, sf_dir: fn(
        ingest.storable(testbed.login_events(spark, sf_dir, *kinds, k_once=k)))


def _on_raw(fn: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: fn(testbed.raw_messages(spark, sf_dir))


def _counter(name: str, *kinds: str, k: bool = True) -> Query:
    return _on_events(lambda e: metrics.counter(e, name), *kinds, k=k)


# ---- decoding ---------------------------------------------------------------------

def decode_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (testbed.raw_events(spark, sf_dir)
            .select("event_id", F.from_json("props", "k int").alias("props"))
            .select("event_id", "props.k"))


def kafka_envelope(raw: DataFrame) -> DataFrame:
    rows = ingest.envelope(testbed.kafka_rows(raw))
    return rows.select("topic", "partition", "offset", plain("timestamp"), "value")


def event_time_derive(raw: DataFrame) -> DataFrame:
    rows = ingest.with_event_time(ingest.decode(raw))
    return rows.select("event_id", plain("event_time"), "malformed")


def default_timestamp(raw: DataFrame) -> DataFrame:
    filled = ingest.with_default_timestamp(ingest.decode(raw),
                                           F.lit(DEFAULT_TIME).cast("timestamp"))
    return ingest.with_event_time(filled).select("event_id", plain("event_time"))


def encode_json(events: DataFrame) -> DataFrame:
    return ingest.encode(ingest.event_messages(events, "event_id"), "event_id")


def flatten_event(raw: DataFrame) -> DataFrame:
    rows = ingest.flatten(ingest.with_event_time(ingest.decode(raw)))
    return rows.select("event_id", "event_type", "user_id", "device_id", "device_type",
                       "os_type", "city", "latitude", "longitude",
                       F.col("authentication_method").alias("login_method"),
                       "success", "failure_reason")


def route_events(raw: DataFrame) -> DataFrame:
    return ingest.with_route(ingest.decode(raw)).select("event_id", "route")


def valid_events(raw: DataFrame) -> DataFrame:
    return ingest.valid_events(raw).select(
        "event_id", plain("event_time"), "user_id", "event_type", "device_id", "device_type",
        "os_type", "city", "latitude", "longitude", "authentication_method", "success",
        "failure_reason", "activity_type", "risk_level", "username", "account_type")


def dead_letters(raw: DataFrame) -> DataFrame:
    return ingest.dead_letters(raw).select(
        "event_id", "error_type", "details", "location.city", "location.latitude",
        "location.longitude", plain("timestamp"))


# ---- rows -------------------------------------------------------------------------

def filter_logins(events: DataFrame) -> DataFrame:
    return (events.filter(F.col("event_type") == "login")
            .select("event_id", plain("event_time"), "user_id", "authentication_method",
                    "success"))


def filter_failed_logins(events: DataFrame) -> DataFrame:
    return (events.filter((F.col("event_type") == "login") & ~F.col("success"))
            .select("event_id", plain("event_time"), "user_id", "failure_reason"))


def fill_defaults(events: DataFrame) -> DataFrame:
    return ingest.fill_defaults(store_queries.session_rows(events)).select(
        "event_id", "city", "latitude", "longitude", "device_type", "os_type", "success")


def topn_preview(events: DataFrame) -> DataFrame:
    table = rates.login_rates(events, rates.COMBO_KEYS)
    return store_queries.top_rows(table, ["city", "no_such_column", "device_type",
                                          "login_method"], 50)


def _history(start: str | None = None, end: str | None = None) -> Query:
    def run(stored: DataFrame) -> DataFrame:
        rows = store_queries.login_history(stored, HISTORY_USER, start, end)
        return rows.select("event_id", plain("event_time"), "user_id", "event_type",
                           "device_id", "device_type", "city", "authentication_method",
                           "success", "failure_reason")
    return _on_stored(run, LOGIN, LOGOUT)


def _session_columns(rows: DataFrame) -> DataFrame:
    return rows.select("user_id", "event_id", plain("event_time"),
                       *[c for c in jobs.SESSION_COLUMNS if c != "event_type"])


def active_sessions(stored: DataFrame) -> DataFrame:
    return _session_columns(
        store_queries.active_sessions(stored, columns=jobs.SESSION_COLUMNS))


def active_sessions_successful(stored: DataFrame) -> DataFrame:
    return _session_columns(
        store_queries.active_sessions(stored, successful_only=True,
                                      columns=jobs.SESSION_COLUMNS))


# ---- users --------------------------------------------------------------------------

def _place(column: str, prefix: str) -> list[Column]:
    return [F.col(f"{column}.{f}").alias(f"{prefix}_{f}")
            for f in ("city", "latitude", "longitude")]


def _flat_profiles(profiles: DataFrame) -> DataFrame:
    return profiles.select(
        "user_id", plain("last_login"),
        F.col("last_device.device_id").alias("last_device_id"),
        F.col("last_device.device_type").alias("last_device_type"),
        F.col("last_device.os_type").alias("last_os_type"),
        *_place("last_location", "last"), "failed_attempts")


def user_profiles(stored: DataFrame) -> DataFrame:
    return _flat_profiles(users.user_profiles(stored))


def registered_users(stored: DataFrame) -> DataFrame:
    return users.registered_users(stored).select(
        "user_id", "username", "account_type",
        F.element_at("device_ids", 1).alias("device_id"),
        F.size("device_ids").cast("bigint").alias("devices"),
        "account_status", plain("created_at"), plain("last_login"), "failed_attempts",
        *_place("registered_location", "registered"))


def users_table(stored: DataFrame) -> DataFrame:
    return _flat_users(users.users_table(stored))


def _flat_users(rows: DataFrame) -> DataFrame:
    return rows.select(
        "user_id", "username", "account_type",
        F.element_at("device_ids", 1).alias("device_id"),
        "account_status", plain("created_at"), *_place("registered_location", "registered"),
        plain("last_login"), F.col("last_device.device_id").alias("last_device_id"),
        *_place("last_location", "last"), "failed_attempts")


# ---- metrics --------------------------------------------------------------------------

def security_alerts(stored: DataFrame) -> DataFrame:
    return store_queries.recent_failures(stored, testbed.AS_OF).withColumnRenamed(
        "count", "value")


def device_gauge(stored: DataFrame) -> DataFrame:
    return (store_queries.device_distribution(stored)
            .filter("device_type <> ''").withColumnRenamed("count", "value"))


def session_duration_histogram(events: DataFrame) -> DataFrame:
    return metrics.histogram(sessions.session_durations(events), "session_duration",
                             ["device_type"], testbed.DURATION_BUCKETS)


def value_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.histogram(testbed.raw_events(spark, sf_dir), "value", ["event_type"],
                             (5.0, 10.0, 25.0, 50.0, 100.0, 250.0))


def value_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.summary(testbed.raw_events(spark, sf_dir), "value", ["event_type"])


def active_sessions_current(stored: DataFrame) -> DataFrame:
    by_device = metrics.active_by_device(
        store_queries.active_sessions(stored, columns=metrics.ACTIVE_COLUMNS))
    return by_device.select("device_type", F.col("active_sessions").alias("value"))


def unique_devices_active(stored: DataFrame) -> DataFrame:
    by_device = metrics.active_by_device(
        store_queries.active_sessions(stored, columns=metrics.ACTIVE_COLUMNS))
    return by_device.select("device_type", F.col("unique_devices").alias("value"))


def label_text(labels: str = "labels") -> Column:
    """name=value pairs in name order, as one text."""
    entries = F.array_sort(F.map_entries(labels))
    return F.array_join(F.transform(entries, lambda e: F.concat(
        e["key"], F.lit("="), F.coalesce(e["value"], F.lit("null")))), ",")


def metrics_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    errors = ingest.dead_letters(testbed.raw_messages(spark, sf_dir))
    events = testbed.login_events(spark, sf_dir).withColumn("stored", ingest.is_storable())
    rows = metrics.metrics_snapshot(events, testbed.AS_OF, testbed.DURATION_BUCKETS, errors)
    return rows.select("metric", label_text().alias("labels"), "value")


# ---- trends and rules --------------------------------------------------------------------

def _with_plain(*columns: str) -> Callable[[DataFrame], DataFrame]:
    return lambda df: df.withColumns({c: plain(c) for c in columns})


def session_durations(events: DataFrame) -> DataFrame:
    return _with_plain("event_time")(sessions.session_durations(events))


def session_durations_in_slots(events: DataFrame) -> DataFrame:
    """The same with slots of six hours, which hold several rows of a user."""
    return _with_plain("event_time")(sessions.session_durations(events, slot_seconds=6 * 3600))


def activity_trend(events: DataFrame) -> DataFrame:
    return _with_plain("window_start")(sessions.activity_trend(events))


def active_sessions_trend(events: DataFrame) -> DataFrame:
    return _with_plain("window_start")(sessions.active_sessions_trend(events))


def rule_multiple_failed(events: DataFrame) -> DataFrame:
    rows = rules.multiple_failed_attempts(events)
    return rows.select("event_id", "user_id", plain("event_time"))


def rule_unusual_location(events: DataFrame) -> DataFrame:
    return _with_plain("event_time")(rules.unusual_location(events))


def rule_device_switch(events: DataFrame) -> DataFrame:
    return _with_plain("event_time")(rules.rapid_device_switch(events, 6 * 3600))


def rule_failed_windows(events: DataFrame) -> DataFrame:
    return _with_plain("window_start")(rules.failed_windows(events))


def suspicious_events(events: DataFrame) -> DataFrame:
    return _with_plain("event_time")(rules.suspicious_events(events))


# ---- streams: several micro-batches and a restart, then read back ---------------------------

def _cores(spark: SparkSession) -> int:
    """State partitions for one drained run: one per core of the session."""
    return spark.sparkContext.defaultParallelism


# Files of a micro-batch where a query is measured: all of the table's, if it has no more.
AT_ONCE = 64


def event_stream(spark: SparkSession, sf_dir: str, files: int | None = None,
                 k: bool = True, mixed: bool = False) -> DataFrame:
    """The whole table in files that follow in time, a slice of them per micro-batch unless
    ``files`` are named; ``k`` as in ``_on_events``, ``mixed`` as in ``event_slices``."""
    folder, of_slice = testbed.event_slices(spark, sf_dir, mixed)
    return testbed.to_login_events(parquet_stream(
        spark, folder, testbed.EVENTS_SCHEMA, files or of_slice), k)


def _run(start: Callable[[], StreamingQuery | list[StreamingQuery]]) -> None:
    """Stop the queries somewhere behind their second micro-batch, start them again
    from their checkpoints and let them take the rest."""
    for query in _listed(start()):
        while query.isActive and not (query.lastProgress and query.lastProgress["batchId"] >= 1):
            time.sleep(0.05)
        query.stop()
    jobs.await_each(_listed(start()))


def _streamed(start: Callable, read: Callable[[SparkSession, str], DataFrame],
              stored: bool = False) -> Query:
    """Run ``start`` (events, folder, state partitions) and read its result."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        base = shared_folder(spark)
        events = event_stream(spark, sf_dir)
        if stored:
            events = ingest.storable(events)
        _run(lambda: start(events, base, _cores(spark)))
        return read(spark, base)

    def drained(spark: SparkSession, sf_dir: str) -> DataFrame:
        base = shared_folder(spark)
        events = event_stream(spark, sf_dir, AT_ONCE)
        if stored:
            events = ingest.storable(events)
        jobs.await_each(_listed(start(events, base, _cores(spark))))
        return read(spark, base)

    run.drained = drained
    return run


def _listed(queries: StreamingQuery | list[StreamingQuery]) -> list[StreamingQuery]:
    return queries if isinstance(queries, list) else [queries]


def _closed(start: Callable, read: Callable[[SparkSession, str], DataFrame],
            k: bool = False) -> Query:
    """Like ``_streamed`` for queries whose rows wait for the watermark: in the end a
    tick says that no more is to come. ``start`` gets the ticks as well."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        base = shared_folder(spark)
        events = event_stream(spark, sf_dir, k=k)

        def started() -> StreamingQuery | list[StreamingQuery]:
            return start(events, base, _cores(spark), tick_stream(spark, f"{base}/ticks"))

        _run(started)
        last = testbed.raw_events(spark, sf_dir).agg(F.max("ts")).first()[0]
        tick(spark, f"{base}/ticks", last + timedelta(days=2))
        jobs.await_each(_listed(started()))
        return read(spark, base)

    def drained(spark: SparkSession, sf_dir: str) -> DataFrame:
        base = shared_folder(spark)
        ticks = tick_stream(spark, f"{base}/ticks")
        tick(spark, f"{base}/ticks", datetime(2100, 1, 1))
        jobs.await_each(_listed(start(event_stream(spark, sf_dir, AT_ONCE, k), base, _cores(spark),
                                      ticks)))
        return read(spark, base)

    run.drained = drained
    return run


def _rule(name: str, *columns: str, **options) -> Query:
    return _closed(
        lambda e, base, n, ticks: jobs.start_rule(e, name, base, None, n, ticks=ticks, **options),
        lambda spark, base: _with_plain("event_time")(
            spark.read.parquet(f"{base}/{name}").select(
                "event_id", "user_id", "event_time", *columns)), k=True)


def _live_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected messages counted from decoded files, as monitoring does."""
    base = shared_folder(spark)
    messages = with_event_id(testbed.to_raw_messages(event_stream(spark, sf_dir)))
    _run(lambda: jobs.start_decoded(messages, base, None))
    jobs.start_errors(jobs.decoded_stream(spark, base), base, None).awaitTermination()
    return read_snapshot(spark, f"{base}/errors_total")


def _late_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trend of files out of order under a short watermark, with its late rows folded in."""
    base = shared_folder(spark)
    events = event_stream(spark, sf_dir, mixed=True)
    _run(lambda: [
        jobs.start_activity_trend(events, base, watermark="1 minute", every=None),
        jobs.start_late_rows(events, base, "1 minute", every=None)])
    jobs.fold_late_trend(spark, base, testbed.login_events(spark, sf_dir))
    return _with_plain("window_start")(jobs.read_trend(spark, base))


def _late_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Durations of files out of order, with the users of late rows paired anew."""
    base = shared_folder(spark)
    events = event_stream(spark, sf_dir, mixed=True)

    def started() -> list[StreamingQuery]:
        ticks = tick_stream(spark, f"{base}/ticks")
        return [jobs.start_session_durations(events, base, None, _cores(spark), "1 minute", ticks),
                jobs.start_late_rows(events, base, "1 minute", every=None)]

    _run(started)
    last = testbed.raw_events(spark, sf_dir).agg(F.max("ts")).first()[0]
    tick(spark, f"{base}/ticks", last + timedelta(days=2))
    jobs.await_each(started())
    jobs.fold_late_durations(spark, base, testbed.login_events(spark, sf_dir))
    return _with_plain("event_time")(jobs.read_session_durations(spark, base).drop("late"))


def _triggered_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session counters of a query that is triggered by the clock, awaited, and stopped."""
    base = shared_folder(spark)
    spark.streams.resetTerminated()
    query = jobs.start_session_counters(event_stream(spark, sf_dir), base, "500 milliseconds")
    query.processAllAvailable()
    Timer(0.2, query.stop).start()
    jobs.await_any(spark)
    return read_snapshot(spark, f"{base}/session_counters")


def _progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that the progress table says were read, over a stop and a restart."""
    base = shared_folder(spark)
    log = jobs.log_progress(spark, base)
    try:
        _run(lambda: jobs.start_session_counters(event_stream(spark, sf_dir), base, None))
        # Reports come by the listener bus, some time after their micro-batch.
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(log)
    # An epoch that was stopped half-way and repeated reports once, when it is complete.
    return (jobs.read_progress(spark, base).filter("query = 'session_counters'")
            .groupBy("query", "batchId").agg(F.max("numInputRows").alias("n"))
            .groupBy("query").agg(F.sum("n").alias("rows_read")))


def store_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the store by table and date, after three batches were joined."""
    store = EventStore(spark, shared_folder(spark))
    raw = testbed.raw_messages(spark, sf_dir)
    # A third of the batches is open and stays as it is.
    for batch in range(3):
        store.append(raw.filter(F.col("event_id") % 3 == batch), batch,
                     default_time=F.lit(testbed.AS_OF).cast("timestamp"))
    store.compact(date(2024, 1, 20))
    rows = store.rows("login_events", "security_events", "registrations", "system_errors")
    return (rows.groupBy(F.col("table").alias("table_name"))
            .agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"),
                 F.count_distinct("event_id").alias("distinct_ids")))


def _snapshot(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, base: read_snapshot(spark, f"{base}/{name}")


def _changes(name: str, keys: Sequence[str]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, base: read_changes(spark, f"{base}/{name}", keys)


def _stream_table(name: str) -> Query:
    return _streamed(lambda e, base, n: jobs.start_rate_table(e, name, base, None),
                     _snapshot(name))


def _shared_tables(spark: SparkSession, base: str) -> DataFrame:
    """All five tables of the shared query, one below the other."""
    out = None
    for name in jobs.TRIGGERS:
        table = read_snapshot(spark, f"{base}/{name}")
        keys = [c for c in ("city", "device_type", "login_method", "reason")
                if c in table.columns]
        total = "count" if name == "failure_metrics" else "total_attempts"
        failed = "count" if name == "failure_metrics" else "failed_attempts"
        rows = table.select(
            F.lit(name).alias("table_name"),
            F.concat_ws("/", *[F.coalesce(k, F.lit("null")) for k in keys]).alias("group_key"),
            F.col(total).alias("total_attempts"), F.col(failed).alias("failed_attempts"))
        out = rows if out is None else out.unionByName(rows)
    return out


def _labelled(rows: DataFrame) -> DataFrame:
    return rows.select("metric", label_text().alias("labels"), "value")


STREAMS = {
    **{f"stream_{name}": _stream_table(name) for name in jobs.TRIGGERS},
    "stream_shared_rate_tables": _streamed(
        lambda e, base, n: jobs.start_shared_rate_tables(e, base, None), _shared_tables),
    "stream_session_counters": _streamed(
        lambda e, base, n: jobs.start_session_counters(e, base, None),
        _snapshot("session_counters")),
    "stream_active_sessions_by_device": _streamed(
        lambda e, base, n: jobs.start_active_sessions_by_device(e, base, None),
        _snapshot("active_sessions_by_device")),
    "stream_counters": _streamed(
        lambda e, base, n: [jobs.start_counters(e, base, None),
                            jobs.start_place_counts(e, base, None, n)],
        lambda spark, base: _labelled(jobs.read_counters(spark, base))),
    "stream_gauges": _streamed(
        lambda e, base, n: gauges.start_gauges(e, base, None, n),
        lambda spark, base: _labelled(gauges.read_gauges(
            spark, base, datetime.fromisoformat(testbed.AS_OF))), stored=True),
    "stream_active_sessions": _streamed(
        lambda e, base, n: jobs.start_latest_sessions(e, base, None, n),
        lambda spark, base: _session_columns(jobs.read_active_sessions(spark, base)),
        stored=True),
    "stream_failed_windows": _streamed(
        lambda e, base, n: jobs.start_failed_windows(e, base, every=None, partitions=n),
        lambda spark, base: _with_plain("window_start")(
            _changes("failed_windows", jobs.FAILED_WINDOW_KEYS)(spark, base))),
    "stream_activity_trend": _streamed(
        lambda e, base, n: jobs.start_activity_trend(e, base, every=None),
        lambda spark, base: _with_plain("window_start")(
            _changes("activity_trend", jobs.TREND_KEYS)(spark, base))),
    "stream_user_profile": _streamed(
        lambda e, base, n: jobs.start_user_profiles(e, base, None, n),
        lambda spark, base: _flat_profiles(
            _changes("user_profiles", jobs.PROFILE_KEYS)(spark, base)), stored=True),
    "stream_users_table": _streamed(
        lambda e, base, n: jobs.start_users_table(e, base, None, n),
        lambda spark, base: _flat_users(
            _changes("users_table", jobs.USERS_KEYS)(spark, base)), stored=True),
    "stream_session_durations": _closed(
        lambda e, base, n, ticks: jobs.start_session_durations(e, base, None, n, ticks=ticks),
        lambda spark, base: _with_plain("event_time")(jobs.read_session_durations(spark, base))),
    "stream_late_durations": _late_durations,
    "stream_late_trend": _late_trend,
    "stream_duration_histogram": _closed(
        lambda e, base, n, ticks: jobs.start_duration_histogram(
            e, base, testbed.DURATION_BUCKETS, None, n, ticks=ticks),
        lambda spark, base: jobs.read_duration_histogram(
            spark, base, testbed.DURATION_BUCKETS)),
    "stream_rule_multiple_failed": _rule("rule_multiple_failed"),
    "stream_rule_unusual_location": _rule("rule_unusual_location", "city", "previous_city"),
    "stream_rule_device_switch": _rule(
        "rule_device_switch", "device_id", "previous_device", "seconds_since",
        span_seconds=21600),
    "stream_running_sessions": _streamed(
        lambda e, base, n: gauges.start_running_sessions(e, base, None, n),
        lambda spark, base: _with_plain("window_start")(
            gauges.read_running_sessions(spark, base))),
    "stream_unique_devices": _streamed(
        lambda e, base, n: gauges.start_device_sketches(e, base, None, n),
        lambda spark, base: gauges.read_unique_devices(spark, base)),
    "stream_errors_total": _live_errors,
    "stream_triggered_counters": _triggered_counters,
    "stream_progress": _progress,
    "stream_user_status": _streamed(
        lambda e, base, n: jobs.start_users_table(e, base, None, n), jobs.read_user_status,
        stored=True),
}


def _combo(events: DataFrame) -> DataFrame:
    return rates.login_rates(events, rates.COMBO_KEYS)


def catalog() -> dict[str, Query]:
    return {
        # decoding and routing
        "decode_json": decode_json,
        "kafka_envelope": _on_raw(kafka_envelope),
        "event_time_derive": _on_raw(event_time_derive),
        "default_timestamp": _on_raw(default_timestamp),
        "encode_json": _on_events(encode_json, LOGIN, LOGOUT, SUSPICIOUS),
        "flatten_event": _on_raw(flatten_event),
        "route_events": _on_raw(route_events),
        "valid_events": _on_raw(valid_events),
        "dead_letters": _on_raw(dead_letters),
        "filter_logins": _on_events(filter_logins, LOGIN, k=False),
        "filter_failed_logins": _on_events(filter_failed_logins, LOGIN),
        "fill_defaults": _on_events(fill_defaults, LOGIN, LOGOUT),
        "topn_preview": _on_events(topn_preview, LOGIN),
        # rate tables
        "combo_metrics": _on_events(_combo, LOGIN),
        "city_metrics": _on_events(lambda e: rates.login_rates(e, ["city"]), LOGIN),
        "method_metrics": _on_events(
            lambda e: rates.login_rates(e, ["login_method"]), LOGIN, k=False),
        "device_metrics": _on_events(
            lambda e: rates.login_rates(e, ["device_type"]), LOGIN, k=False),
        "failure_metrics": _on_events(rates.failure_counts, LOGIN),
        "login_rate_grouping_sets": _on_events(rates.login_rate_grouping_sets, LOGIN),
        # event-store queries
        "store_attempts_by_method": _on_stored(
            store_queries.attempts_by_method, LOGIN, LOGOUT, k=False),
        "device_distribution": _on_stored(
            store_queries.device_distribution, LOGIN, LOGOUT, k=False),
        "location_distribution": _on_stored(store_queries.location_distribution, LOGIN, LOGOUT),
        "security_failures_24h": _on_stored(
            lambda e: store_queries.recent_failures(e, testbed.AS_OF), LOGIN, LOGOUT),
        "login_history": _history(),
        "login_history_from": _history(start=HISTORY_START),
        "login_history_until": _history(end=HISTORY_END),
        "login_history_between": _history(HISTORY_START, HISTORY_END),
        "active_sessions": _on_stored(active_sessions, LOGIN, LOGOUT),
        "active_sessions_successful": _on_stored(active_sessions_successful, LOGIN, LOGOUT),
        "store_compacted": store_compacted,
        # counters, gauges, histograms
        "session_counters": _on_events(metrics.session_counters, LOGIN, LOGOUT, k=False),
        "active_sessions_by_device": _counter("active_sessions_by_device", LOGIN, LOGOUT, k=False),
        "login_attempts_total": _counter("login_attempts_total", LOGIN, k=False),
        "store_login_attempts_total": _on_stored(
            lambda e: metrics.store_login_attempts(store_queries.attempts_by_method(e)),
            LOGIN, LOGOUT, k=False),
        "auth_failures_total": _counter("authentication_failures_total", LOGIN),
        "device_connections_total": _counter("device_connections_total", LOGIN),
        "suspicious_activities_total": _counter("suspicious_activities_total", SUSPICIOUS),
        "suspicious_activities_by_city": _counter("suspicious_activities_by_city", SUSPICIOUS),
        "login_locations_total": _counter("login_locations_total", LOGIN),
        "login_locations_active": _counter("login_locations_active", LOGIN),
        "logouts_by_device_city": _counter("logouts_total", LOGOUT),
        "security_alerts_current": _on_stored(security_alerts, LOGIN, LOGOUT),
        "device_gauge": _on_stored(device_gauge, LOGIN, LOGOUT, k=False),
        "concurrent_users": _on_stored(
            lambda e: metrics.concurrent_users(
                store_queries.active_sessions(e, columns=["event_type"])), LOGIN, LOGOUT, k=False),
        "active_sessions_current": _on_stored(active_sessions_current, LOGIN, LOGOUT, k=False),
        "unique_devices_active": _on_stored(unique_devices_active, LOGIN, LOGOUT, k=False),
        "session_duration_histogram": _on_events(
            session_duration_histogram, LOGIN, LOGOUT, k=False),
        "value_histogram": value_histogram,
        "value_summary": value_summary,
        "errors_total": _on_raw(lambda r: metrics.errors_total(ingest.dead_letters(r))),
        "metrics_snapshot": metrics_snapshot,
        # users
        "user_profiles": _on_stored(user_profiles, LOGIN),
        "registered_users": _on_stored(registered_users, REGISTRATION),
        "users_table": _on_stored(users_table, LOGIN, REGISTRATION),
        "user_status": _on_stored(lambda e: users.user_status(users.users_table(e)),
                                  LOGIN, REGISTRATION),
        # sessions, trends, rules
        "session_durations": _on_events(session_durations, LOGIN, LOGOUT, k=False),
        "session_durations_in_slots": _on_events(
            session_durations_in_slots, LOGIN, LOGOUT, k=False),
        "activity_trend": _on_events(activity_trend),
        "active_sessions_trend": _on_events(active_sessions_trend, LOGIN, LOGOUT, k=False),
        "rule_multiple_failed": _on_events(rule_multiple_failed, LOGIN),
        "rule_failed_windows": _on_events(rule_failed_windows, LOGIN),
        "rule_unusual_location": _on_events(rule_unusual_location, LOGIN),
        "rule_device_switch": _on_events(rule_device_switch, LOGIN, k=False),
        "suspicious_events": _on_events(suspicious_events, LOGIN, SUSPICIOUS),
        # streams
        **STREAMS,
    }
