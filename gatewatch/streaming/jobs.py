"""Starting, awaiting and reading the streaming queries."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

from gatewatch.functions import is_kind, success_count
from gatewatch.operators import (
    ingest,
    metrics,
    rates,
    rules,
    sessions,
    store_queries,
    users,
)
from gatewatch.schema import LOGIN
from gatewatch.session import SETTINGS
from gatewatch.sources.folders import (
    complete_versions,
    make_folder,
    remove_version,
    write_text,
)
from gatewatch.sources.store import ERROR_COLUMNS, STORE_SCHEMA, EventStore, routed_rows
from gatewatch.streaming.ordered import DELAY, lag_stream
from gatewatch.streaming.sinks import (
    Sink,
    changes_sink,
    date_bucket,
    read_changes,
    read_snapshot,
    snapshot_sink,
)

# Table name -> processing-time trigger, one query per table.
TRIGGERS = {
    "combo_metrics": "2 minutes",
    "city_metrics": "4 minutes",
    "failure_metrics": "4 minutes",
    "method_metrics": "4 minutes",
    "device_metrics": "4 minutes",
}
# Rows of the sorted preview.
PREVIEW_ROWS = {
    "combo_metrics": 100,
    "city_metrics": 50,
    "failure_metrics": 20,
    "method_metrics": 20,
    "device_metrics": 20,
}
SINGLE_QUERY_TRIGGER = "10 seconds"
METRICS_TRIGGER = "2 seconds"
STORE_TRIGGER = "10 minutes"
# Files of decoded messages that a reader takes per micro-batch, so that one that has fallen
# behind catches up in steps.
DECODED_FILES = 1000
# Partitions of the states that hold combinations of labels with few values.
LABEL_PARTITIONS = 4


# What the rate and failure tables look at.
RATE_FIELDS = ("event_type", "timestamp", "device_info", "device_type", "location",
               "authentication_method", "success", "failure_reason")


def decoded_events(messages: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """Canonical events of the analytics path: decoded, not validated."""
    rows = ingest.with_event_time(ingest.decode(messages, fields=fields))
    return ingest.flatten(rows)


def rate_table(events: DataFrame, name: str) -> DataFrame:
    if name == "failure_metrics":
        return rates.failure_counts(events)
    return rates.login_rates(events, rates.RATE_TABLES[name])


def order_of(name: str) -> Sequence[str]:
    return ("reason",) if name == "failure_metrics" else rates.RATE_TABLES[name]


@contextmanager
def state_partitions(spark: SparkSession, number: int | None) -> Iterator[None]:
    """Partitions of the state of a query started inside; None keeps the session's.

    A query remembers the number in its first checkpoint, so it is chosen per
    query: few for tables of label combinations, many for state per user.
    """
    before = spark.conf.get("spark.sql.shuffle.partitions")
    if number:
        spark.conf.set("spark.sql.shuffle.partitions", number)
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


# What arbitrary state needs; a query takes the settings along when it starts. Changes are
# written as such, so a commit does not upload the files of the store.
STATE_STORE = {name: SETTINGS[name] for name in SETTINGS if ".stateStore." in name}


@contextmanager
def rocks_db(spark: SparkSession) -> Iterator[None]:
    before = {name: spark.conf.get(name, None) for name in STATE_STORE}
    for name, value in STATE_STORE.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def start_appended(df: DataFrame, name: str, base: str, every: str | None,
                   partitions: int | None = None, **options) -> StreamingQuery:
    """Append the rows of a query to Parquet files ``base``/name, exactly once.

    ``options`` are those of the file sink.
    """
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    make_folder(df.sparkSession, f"{base}/{name}")
    with state_partitions(df.sparkSession, partitions), rocks_db(df.sparkSession):
        return (df.writeStream.queryName(name).outputMode("append").trigger(**trigger)
                .option("checkpointLocation", f"{base}/checkpoints/{name}")
                .options(**options)
                .format("parquet").option("path", f"{base}/{name}").start())


def start(df: DataFrame, name: str, base: str, sink: Sink, mode: str,
          every: str | None, partitions: int | None = None) -> StreamingQuery:
    """Run a query with its checkpoint below ``base``; ``every`` None drains
    what is there and stops. Sink errors fail the query, which then resumes
    from its checkpoint."""
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    with state_partitions(df.sparkSession, partitions):
        return (df.writeStream.queryName(name).outputMode(mode).trigger(**trigger)
                .option("checkpointLocation", f"{base}/checkpoints/{name}")
                .foreachBatch(sink).start())


def start_rate_table(events: DataFrame, name: str, base: str, every: str | None,
                     preview: bool = False) -> StreamingQuery:
    """One complete-mode query that replaces ``base``/name at each trigger."""
    sink = snapshot_sink(f"{base}/{name}", order_of(name), PREVIEW_ROWS[name] if preview else 0)
    return start(rate_table(events, name), name, base, sink, "complete", every,
                 LABEL_PARTITIONS)


def start_rate_tables(events: DataFrame, base: str, drain: bool = False,
                      preview: bool = False) -> list[StreamingQuery]:
    """The five tables as five queries, each with its own trigger."""
    return [start_rate_table(events, name, base, None if drain else every, preview)
            for name, every in TRIGGERS.items()]


def login_cells(events: DataFrame) -> DataFrame:
    """Attempts per combination of everything the five tables group by."""
    return (events.filter(is_kind(LOGIN))
            .groupBy("city", "device_type",
                     F.col("authentication_method").alias("login_method"),
                     "success", "failure_reason")
            .agg(F.count(F.lit(1)).alias("total_attempts"),
                 success_count().alias("successful_attempts")))


def tables_from_cells(cells: DataFrame) -> dict[str, DataFrame]:
    tables = {name: rates.roll_up(cells, keys) for name, keys in rates.RATE_TABLES.items()}
    tables["failure_metrics"] = (cells.filter(~F.col("success"))
                                 .groupBy(F.col("failure_reason").alias("reason"))
                                 .agg(F.sum("total_attempts").alias("count")))
    return tables


def start_shared_rate_tables(events: DataFrame, base: str,
                             every: str | None = SINGLE_QUERY_TRIGGER) -> StreamingQuery:
    """The five tables from one query: the source is read once, one state is
    kept, and each trigger adds the counts up to the five tables."""
    sinks = {name: snapshot_sink(f"{base}/{name}") for name in TRIGGERS}

    def write_all(cells: DataFrame, epoch: int) -> None:
        cells.persist()
        try:
            for name, table in tables_from_cells(cells).items():
                sinks[name](table, epoch)
        finally:
            cells.unpersist()

    return start(login_cells(events), "shared_rate_tables", base, write_all, "complete", every,
                 LABEL_PARTITIONS)


def start_session_counters(events: DataFrame, base: str,
                           every: str | None = METRICS_TRIGGER) -> StreamingQuery:
    return start(metrics.session_counters(events), "session_counters", base,
                 snapshot_sink(f"{base}/session_counters"), "complete", every,
                 LABEL_PARTITIONS)


def start_active_sessions_by_device(events: DataFrame, base: str,
                                    every: str | None = METRICS_TRIGGER) -> StreamingQuery:
    name = "active_sessions_by_device"
    return start(metrics.counter(events, name), name, base,
                 snapshot_sink(f"{base}/{name}"), "complete", every, LABEL_PARTITIONS)


def start_counters(events: DataFrame, base: str,
                   every: str | None = METRICS_TRIGGER) -> StreamingQuery:
    """All event counters as metric, labels and value; the state holds one row per
    label combination. Places, which have coordinates, are ``start_place_counts``."""
    write = snapshot_sink(f"{base}/counters")

    def expose(counts: DataFrame, epoch: int) -> None:
        write(metrics.with_label_map(metrics.counter_samples(counts)), epoch)

    return start(metrics.label_counts(events), "counters", base, expose, "complete", every,
                 LABEL_PARTITIONS)


def start_place_counts(events: DataFrame, base: str, every: str | None = METRICS_TRIGGER,
                       partitions: int | None = None) -> StreamingQuery:
    """Successful logins per place; only the places of each micro-batch are written."""
    return start(metrics.place_counts(events), "place_counts", base,
                 changes_sink(f"{base}/place_counts", metrics.PLACE_SOURCES), "update", every,
                 partitions)


def read_counters(spark: SparkSession, base: str) -> DataFrame:
    """Samples of all counters and of the location gauge."""
    places = read_changes(spark, f"{base}/place_counts", metrics.PLACE_SOURCES)
    return read_snapshot(spark, f"{base}/counters").unionByName(
        metrics.with_label_map(metrics.place_samples(places)))


SESSION_KEYS = ("user_id",)
SESSION_COLUMNS = ("event_type", "device_id", "device_type", "os_type", "city",
                   "authentication_method", "success")


def start_latest_sessions(events: DataFrame, base: str,
                          every: str | None = METRICS_TRIGGER,
                          partitions: int | None = None) -> StreamingQuery:
    """Keep each user's latest login or logout; see ``read_active_sessions``."""
    latest = store_queries.latest_session_rows(events, SESSION_COLUMNS)
    return start(latest, "latest_sessions", base, changes_sink(
        f"{base}/latest_sessions", SESSION_KEYS), "update", every, partitions)


def read_active_sessions(spark: SparkSession, base: str) -> DataFrame:
    return (read_changes(spark, f"{base}/latest_sessions", SESSION_KEYS)
            .filter(is_kind(LOGIN)))


FAILED_WINDOW_KEYS = ("window_start", "user_id")


def start_failed_windows(events: DataFrame, base: str, attempts: int = 2,
                         span: str = "24 hours", slide: str = "1 hour",
                         watermark: str | None = None,
                         every: str | None = SINGLE_QUERY_TRIGGER,
                         partitions: int | None = None) -> StreamingQuery:
    """Alert rows of users with too many failures in a sliding window.

    ``watermark`` as in ``start_activity_trend``.
    """
    alerts = rules.failed_windows(_with_watermark(events, watermark), attempts, span, slide)
    return start(alerts, "failed_windows", base,
                 changes_sink(f"{base}/failed_windows", FAILED_WINDOW_KEYS,
                              bucket=date_bucket("window_start")), "update", every, partitions)


TREND_KEYS = ("window_start", "event_type")


def start_activity_trend(events: DataFrame, base: str, width: str = "1 hour",
                         watermark: str | None = None,
                         every: str | None = SINGLE_QUERY_TRIGGER) -> StreamingQuery:
    """Events per window; nothing is dropped unless a watermark is named.

    A watermark lets the state forget closed windows; rows older than it are
    then left out, and ``dropped_rows`` counts them.
    """
    trend = sessions.activity_trend(_with_watermark(events, watermark), width)
    return start(trend, "activity_trend", base,
                 changes_sink(f"{base}/activity_trend", TREND_KEYS,
                              bucket=date_bucket("window_start")), "update", every,
                 LABEL_PARTITIONS)


def _with_watermark(events: DataFrame, watermark: str | None) -> DataFrame:
    return events.withWatermark("event_time", watermark) if watermark else events


def dropped_rows(query: StreamingQuery) -> int:
    """Rows that the recent micro-batches left out as older than the watermark."""
    return sum(op.get("numRowsDroppedByWatermark", 0)
               for p in query.recentProgress for op in p["stateOperators"])


PROFILE_KEYS = ("user_id",)


def start_user_profiles(events: DataFrame, base: str,
                        every: str | None = SINGLE_QUERY_TRIGGER,
                        partitions: int | None = None) -> StreamingQuery:
    """Upsert of user profiles: the fold is state, changed users are written."""
    return start(users.user_profiles(events), "user_profiles", base,
                 changes_sink(f"{base}/user_profiles", PROFILE_KEYS), "update", every, partitions)


USERS_KEYS = ("user_id",)


def start_users_table(events: DataFrame, base: str,
                      every: str | None = SINGLE_QUERY_TRIGGER,
                      partitions: int | None = None) -> StreamingQuery:
    """Registrations and login folds of every user in one upserted table."""
    return start(users.users_table(events), "users_table", base,
                 changes_sink(f"{base}/users_table", USERS_KEYS), "update", every, partitions)


def start_session_durations(events: DataFrame, base: str, every: str | None = SINGLE_QUERY_TRIGGER,
                            partitions: int | None = None, delay: str = DELAY,
                            ticks: DataFrame | None = None,
                            keep_seconds: int | None = None) -> StreamingQuery:
    """Append logout durations; see ``read_session_durations``.

    Rows wait for the watermark (``delay`` behind the newest time) and are then
    paired in order, so they may arrive in any order within it. ``ticks`` move the watermark
    where no events come; ``keep_seconds`` forgets users that are silent that long.
    """
    lag = partial(lag_stream, delay=delay, ticks=ticks, keep_seconds=keep_seconds)
    return start_appended(sessions.session_durations(events, lag=lag), "session_durations", base,
                          every, partitions)


def read_session_durations(spark: SparkSession, base: str) -> DataFrame:
    """One row per logout; ``late`` for those that only ``fold_late_durations`` has paired."""
    seen = spark.read.parquet(f"{base}/session_durations")
    if not complete_versions(spark, f"{base}/late_durations", "epoch"):
        return seen.withColumn("late", F.lit(False))
    folded = read_snapshot(spark, f"{base}/late_durations")
    known = seen.select("event_id", F.lit(False).alias("late"))
    rest = seen.join(folded, "event_id", "left_anti").withColumn("late", F.lit(False))
    return rest.unionByName(folded.join(known, "event_id", "left").withColumn(
        "late", F.col("late").isNull()))


# Rule queries: name -> operator; each reads a user's logins in order of time.
RULES = {
    "rule_multiple_failed": rules.multiple_failed_attempts,
    "rule_unusual_location": rules.unusual_location,
    "rule_device_switch": rules.rapid_device_switch,
}


def start_rule(events: DataFrame, name: str, base: str, every: str | None = SINGLE_QUERY_TRIGGER,
               partitions: int | None = None, delay: str = DELAY,
               ticks: DataFrame | None = None, **options) -> StreamingQuery:
    """Append the logins that a rule marks, each once; ``options`` are those of the rule.

    Rules of a span forget users that are silent for longer than it.
    """
    defaults = {"rule_multiple_failed": 86400, "rule_device_switch": 3600}
    keep = options.get("span_seconds", defaults.get(name))
    lag = partial(lag_stream, delay=delay, ticks=ticks, keep_seconds=keep)
    return start_appended(RULES[name](events, lag=lag, **options), name, base, every, partitions)


def start_duration_histogram(events: DataFrame, base: str, buckets: Sequence[float],
                             every: str | None = SINGLE_QUERY_TRIGGER,
                             partitions: int | None = None, delay: str = DELAY,
                             ticks: DataFrame | None = None,
                             width: str = "1 hour") -> StreamingQuery:
    """Session durations and their buckets per device type and hour in one query.

    Three stateful operators follow each other: slots, pairing, and bucket sums, which
    come out when their hour is over.
    """
    lag = partial(lag_stream, delay=delay, ticks=ticks, chained=True)
    durations = sessions.session_durations(events, lag=lag, also=["slot_end"])
    totals = metrics.histogram_totals(durations, "session_duration",
                                      [F.window("slot_end", width), "device_type"], buckets)
    return start_appended(totals.withColumn("window", F.col("window.start")),
                          "duration_histogram", base, every, partitions)


def read_duration_histogram(spark: SparkSession, base: str,
                            buckets: Sequence[float]) -> DataFrame:
    labels = ["device_type"]
    totals = spark.read.parquet(f"{base}/duration_histogram")
    return metrics.histogram_rows(metrics.add_totals(totals, labels, buckets), labels, buckets)


def start_errors(decoded: DataFrame, base: str, every: str | None = METRICS_TRIGGER
                 ) -> StreamingQuery:
    """Rejected messages per kind of error, from decoded rows."""
    errors = metrics.errors_total(decoded.filter(F.col("error_type").isNotNull()))
    return start(errors, "errors_total", base, snapshot_sink(f"{base}/errors_total"),
                 "complete", every, LABEL_PARTITIONS)


def read_user_status(spark: SparkSession, base: str) -> DataFrame:
    """Users per account status, as ``start_users_table`` has them now."""
    return users.user_status(read_changes(spark, f"{base}/users_table", USERS_KEYS))


# ---- late rows ------------------------------------------------------------------------


def start_late_rows(events: DataFrame, base: str, delay: str = DELAY,
                    every: str | None = SINGLE_QUERY_TRIGGER) -> StreamingQuery:
    """Keep the rows that a watermark of ``delay`` may have left out in a side table.

    A row is kept if it is older than the newest time of its own and all earlier
    micro-batches, less the delay. A query with that watermark that reads the same
    source in the same order leaves out no other rows, however its micro-batches are
    cut; it may have counted some of them, so what they touch is computed anew
    (``fold_late_trend``, ``fold_late_durations``) and not added.
    """
    def write(df: DataFrame, epoch: int) -> None:
        spark = df.sparkSession
        known = complete_versions(spark, f"{base}/late_marks", "epoch")
        if epoch in known:
            return
        newest = df.agg(F.max("event_time").alias("mark"))
        if known:
            newest = newest.unionByName(
                spark.read.schema("mark timestamp").parquet(f"{base}/late_marks/epoch={known[-1]}"))
        newest = newest.agg(F.max("mark").alias("mark"))
        mark = newest.first()[0]
        late = df.filter(F.col("event_time") < F.lit(mark) - F.expr(f"INTERVAL {delay}"))
        late.write.mode("overwrite").parquet(f"{base}/late_rows/epoch={epoch}")
        # The mark is written last: only then does the epoch count.
        (spark.createDataFrame([(mark,)], "mark timestamp").coalesce(1)
         .write.mode("overwrite").parquet(f"{base}/late_marks/epoch={epoch}"))
        for old in known[:-2]:
            remove_version(spark, f"{base}/late_marks", "epoch", old)

    return start(events, "late_rows", base, write, "append", every)


def read_late_rows(spark: SparkSession, base: str) -> DataFrame:
    epochs = complete_versions(spark, f"{base}/late_rows", "epoch")
    marks = complete_versions(spark, f"{base}/late_marks", "epoch")
    counted = [e for e in epochs if marks and e <= marks[-1]]
    if not counted:
        raise FileNotFoundError(f"no committed late rows in {base}")
    return spark.read.parquet(*[f"{base}/late_rows/epoch={e}" for e in counted])


def _next_version(spark: SparkSession, folder: str) -> int:
    return max(complete_versions(spark, folder, "epoch"), default=-1) + 1


def fold_late_trend(spark: SparkSession, base: str, events: DataFrame,
                    width: str = "1 hour") -> None:
    """Count the windows that late rows touch anew from ``events``, all rows there are.

    Batch job beside ``start_activity_trend``; ``events`` with a column ``event_date``, as
    the store has them, are read for the touched dates only.
    """
    start_of = F.window("event_time", width)["start"]
    touched = read_late_rows(spark, base).select(start_of.alias("start")).distinct()
    if "event_date" in events.columns:
        dates = [r[0] for r in touched.select(F.explode(F.array(
            F.to_date("start"), F.to_date(F.col("start") + F.expr(f"INTERVAL {width}")))))
            .distinct().collect()]
        events = events.filter(F.col("event_date").isin(dates))
    rows = (events.withColumn("_start", start_of)
            .join(touched.withColumnRenamed("start", "_start"), "_start", "left_semi"))
    folder = f"{base}/late_trend"
    snapshot_sink(folder)(sessions.activity_trend(rows.drop("_start"), width),
                          _next_version(spark, folder))


def read_trend(spark: SparkSession, base: str) -> DataFrame:
    """The trend with what late rows add; counts only grow, so the larger one is newer."""
    trend = read_changes(spark, f"{base}/activity_trend", TREND_KEYS)
    if not complete_versions(spark, f"{base}/late_trend", "epoch"):
        return trend
    return (trend.unionByName(read_snapshot(spark, f"{base}/late_trend"))
            .groupBy(*TREND_KEYS).agg(F.max("events").alias("events")))


def fold_late_durations(spark: SparkSession, base: str, events: DataFrame) -> None:
    """Pair all rows of users with late rows anew from ``events``, all rows there are."""
    touched = (sessions.session_marks(read_late_rows(spark, base)).select("user_id").distinct())
    folder = f"{base}/late_durations"
    rows = sessions.session_durations(events.join(touched, "user_id", "left_semi"))
    snapshot_sink(folder)(rows, _next_version(spark, folder))


# ---- decoded messages and the store -------------------------------------------------------


def start_decoded(messages: DataFrame, base: str, every: str | None = SINGLE_QUERY_TRIGGER,
                  default_time: Column | None = None,
                  retention: str = "7d") -> StreamingQuery:
    """Append every message, decoded, judged and routed, to Parquet files (exactly once).

    The other monitoring queries read these files, so the topic is read and its
    JSON parsed once however many of them there are. Files older than ``retention`` leave
    the list of files that the readers go through, and may be deleted.
    """
    return start_appended(routed_rows(messages, default_time, unknown=True), "decoded", base,
                          every, retention=retention)


def decoded_stream(spark: SparkSession, base: str) -> DataFrame:
    """What ``start_decoded`` has written; ``table`` is NULL for messages of no known kind."""
    fields = [f for f in STORE_SCHEMA.fields if f.name != "batch"]
    return (spark.readStream.schema(StructType(fields))
            .option("maxFilesPerTrigger", DECODED_FILES).parquet(f"{base}/decoded"))


def valid_rows(decoded: DataFrame) -> DataFrame:
    """The valid events among decoded rows."""
    return (decoded.filter(F.col("table").isNotNull() & F.col("error_type").isNull())
            .drop("table", "event_date", *ERROR_COLUMNS))


def start_store_rows(decoded: DataFrame, store: EventStore, base: str,
                     every: str | None = STORE_TRIGGER) -> StreamingQuery:
    """Like ``start_store``, from decoded rows."""
    return start(decoded.filter(F.col("table").isNotNull()), "event_store", base,
                 lambda df, epoch: store.append_rows(df, epoch), "append", every)


def start_store(messages: DataFrame, store: EventStore, base: str,
                every: str | None = STORE_TRIGGER,
                default_time: Column | None = None) -> StreamingQuery:
    """Append messages to the event store, one folder per micro-batch; a longer
    trigger means fewer and larger files."""
    return start(messages, "event_store", base,
                 lambda df, epoch: store.append(df, epoch, default_time=default_time),
                 "append", every)


def await_any(spark: SparkSession) -> None:
    spark.streams.awaitAnyTermination()


def await_each(queries: Sequence[StreamingQuery]) -> None:
    for query in queries:
        query.awaitTermination()


class ProgressLog(StreamingQueryListener):
    """Writes every progress report to a folder of its query; reports outlive the session."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        name = progress.name or str(progress.id)
        write_text(self.spark, f"{self.folder}/query={name}/date={progress.timestamp[:10]}/"
                   f"{progress.batchId}-{progress.runId}.json",
                   json.dumps(json.loads(progress.json)))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


PROGRESS_SCHEMA = ("query string, date date, id string, runId string, batchId long, "
                   "timestamp string, numInputRows long, durationMs map<string, long>")


def log_progress(spark: SparkSession, base: str) -> ProgressLog:
    """Keep the progress of all queries below ``base``; remove it with
    ``spark.streams.removeListener``."""
    log = ProgressLog(spark, f"{base}/progress")
    make_folder(spark, log.folder)
    spark.streams.addListener(log)
    return log


def read_progress(spark: SparkSession, base: str) -> DataFrame:
    """Micro-batches of all queries and sessions: number, rows and seconds."""
    return (spark.read.schema(PROGRESS_SCHEMA).json(f"{base}/progress")
            .select("query", "date", "runId", "batchId", "timestamp", "numInputRows",
                    (F.coalesce(F.col("durationMs.triggerExecution"), F.lit(0)) / 1000.0)
                    .alias("seconds")))


def batch_seconds(query: StreamingQuery) -> list[tuple[int, float]]:
    """Micro-batch number and duration of the recent progress reports."""
    return [(p["batchId"], p["durationMs"].get("triggerExecution", 0) / 1000.0)
            for p in query.recentProgress]
