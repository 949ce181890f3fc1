"""Store-fed gauges kept up to date by streams; a refresh scans no stored events.

Three running tables carry what the gauges need: totals per method, device type and
outcome; failures per minute; and active sessions per device. A micro-batch reads
and writes only the buckets of what it changed.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gatewatch.functions import is_kind
from gatewatch.operators import metrics, store_queries
from gatewatch.schema import LOGIN, LOGOUT
from gatewatch.streaming import jobs
from gatewatch.streaming.sinks import (
    Sink,
    bucket_count,
    bucket_names,
    changes_sink,
    date_bucket,
    hash_bucket,
    read_changes,
    read_snapshot,
    snapshot_sink,
)

TOTAL_KEYS = ("authentication_method", "device_type", "success")
FAILURE_KEYS = ("minute", "city", "reason")
DEVICE_KEYS = ("device_type", "device_id")


def stored_totals(events: DataFrame) -> DataFrame:
    """Logins and logouts per method, device type and outcome; also on a stream."""
    return (store_queries.session_rows(events).groupBy(*TOTAL_KEYS)
            .agg(F.count(F.lit(1)).alias("n")))


def failures_per_minute(events: DataFrame) -> DataFrame:
    """Failures per minute, city and reason; also on a stream."""
    return (store_queries.session_rows(events).filter(~F.col("success"))
            .groupBy(F.date_trunc("minute", "event_time").alias("minute"), "city",
                     F.nullif(F.col("failure_reason"), F.lit("")).alias("reason"))
            .agg(F.count(F.lit(1)).alias("n")))


def _device_effects(sessions: DataFrame, step: int) -> DataFrame:
    return sessions.filter(is_kind(LOGIN)).select(*DEVICE_KEYS, F.lit(step).alias("n"))


def device_sessions_sink(base: str) -> Sink:
    """Latest session rows, and from their changes the active sessions per device.

    The changed rows are written first and read from there. What the changed users
    had before is read from their buckets only, and as of the epoch before, so a
    repeated epoch gives the same.
    """
    sessions, devices = f"{base}/latest_sessions", f"{base}/device_sessions"
    write_sessions = changes_sink(sessions, jobs.SESSION_KEYS)
    write_devices = changes_sink(devices, DEVICE_KEYS)

    def write(df: DataFrame, epoch: int) -> None:
        spark = df.sparkSession
        write_sessions(df, epoch)
        new = spark.read.schema(df.schema).parquet(f"{sessions}/epoch={epoch}")
        values = _device_effects(new, 1)
        if epoch:
            touched = _buckets_of(new, jobs.SESSION_KEYS, sessions)
            old = read_changes(spark, sessions, jobs.SESSION_KEYS, touched, epoch - 1, new)
            values = values.unionByName(_device_effects(
                old.join(new.select("user_id"), "user_id", "left_semi"), -1))
            changed = values.select(F.struct(*DEVICE_KEYS).alias("key")).distinct()
            before = read_changes(spark, devices, DEVICE_KEYS,
                                  _buckets_of(values, DEVICE_KEYS, devices), epoch - 1,
                                  values)
            values = values.unionByName(before.join(
                changed, F.struct(*DEVICE_KEYS).eqNullSafe(F.col("key")), "left_semi"))
        write_devices(values.groupBy(*DEVICE_KEYS).agg(F.sum("n").alias("n")), epoch)
    return write


def _buckets_of(df: DataFrame, keys: tuple[str, ...], folder: str) -> list[str]:
    """Names of the buckets that rows fall into; there are a fixed number of them."""
    of = hash_bucket(keys, bucket_count(df.sparkSession, folder))
    return [r[0] for r in df.select(of.alias("b")).distinct().collect()]


def start_gauges(events: DataFrame, base: str, every: str | None = jobs.METRICS_TRIGGER,
                 partitions: int | None = None) -> list[StreamingQuery]:
    """Keep the running tables of valid ``events``; see ``read_gauges``.

    Also keeps the latest sessions, so ``jobs.start_latest_sessions`` is not
    needed beside it.
    """
    latest = store_queries.latest_session_rows(events, jobs.SESSION_COLUMNS)
    return [
        jobs.start(stored_totals(events), "stored_totals", base,
                   snapshot_sink(f"{base}/stored_totals"), "complete", every,
                   jobs.LABEL_PARTITIONS),
        jobs.start(failures_per_minute(events), "failures_per_minute", base,
                   changes_sink(f"{base}/failures_per_minute", FAILURE_KEYS,
                                bucket=date_bucket("minute")), "update", every, partitions),
        jobs.start(latest, "device_sessions", base, device_sessions_sink(base), "update", every,
                   partitions),
    ]


def read_gauges(spark: SparkSession, base: str, as_of: datetime) -> DataFrame:
    """The gauges as metric, labels and value, at the full minute of ``as_of``.

    ``as_of`` is a time of the session's time zone. Of the failures only the dates
    of the last 24 hours are read.
    """
    as_of = as_of.replace(second=0, microsecond=0)
    totals = read_snapshot(spark, f"{base}/stored_totals")
    start = store_queries.since(F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp"), 24)
    first = (as_of - timedelta(hours=24)).strftime("%Y-%m-%d")
    # Times may lie ahead of the clock, so dates after ``as_of`` count as well.
    dates = [b for b in bucket_names(spark, f"{base}/failures_per_minute") if b >= first]
    failures = (read_changes(spark, f"{base}/failures_per_minute", FAILURE_KEYS, dates)
                .filter(F.col("minute") >= start)
                .groupBy("city", "reason").agg(F.sum("n").alias("value")))
    attempts = totals.groupBy("authentication_method").agg(
        F.sum("n").alias("total_attempts"),
        F.sum(F.when(F.col("success"), F.col("n")).otherwise(0)).alias("successful_attempts"))
    attempts = attempts.withColumn("failed_attempts",
                                   F.col("total_attempts") - F.col("successful_attempts"))
    devices = (totals.filter("device_type <> ''").groupBy("device_type")
               .agg(F.sum("n").alias("value")))
    active = (read_changes(spark, f"{base}/device_sessions", DEVICE_KEYS).filter("n > 0")
              .groupBy("device_type")
              .agg(F.sum("n").alias("active_sessions"),
                   F.count_if(F.col("device_id").isNotNull()).alias("unique_devices")))
    parts = [
        metrics.table_samples(metrics.store_login_attempts(attempts),
                              "stored_login_attempts_current", ["auth_method", "status"], "value"),
        metrics.table_samples(devices, "device_distribution", ["device_type"], "value"),
        metrics.table_samples(failures, "security_alerts_current", ["city", "reason"], "value"),
        metrics.session_gauges(active),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return metrics.with_label_map(out)



# ---- running sessions -------------------------------------------------------------------

RUNNING_KEYS = ("level", "window_start")


def session_balances(events: DataFrame) -> DataFrame:
    """Logins minus logouts per hour and per day; also on a stream."""
    steps = F.array(*[F.struct(F.lit(level).alias("level"),
                               F.date_trunc(level, "event_time").alias("window_start"))
                      for level in ("hour", "day")])
    return (events.filter(is_kind(LOGIN, LOGOUT) & F.col("event_time").isNotNull())
            .select(F.when(is_kind(LOGIN), 1).otherwise(-1).alias("net"), F.inline(steps))
            .groupBy(*RUNNING_KEYS).agg(F.sum("net").alias("net_change")))


def start_running_sessions(events: DataFrame, base: str, every: str | None = jobs.METRICS_TRIGGER,
                           partitions: int | None = None) -> StreamingQuery:
    """Keep the balance of each hour and day; see ``read_running_sessions``."""
    bucket = F.concat(F.col("level"), F.lit("-"), F.when(
        F.col("level") == "day", F.date_format("window_start", "yyyy-MM")).otherwise(
            F.date_format("window_start", "yyyy-MM-dd")))
    return jobs.start(session_balances(events), "running_sessions", base,
                      changes_sink(f"{base}/running_sessions", RUNNING_KEYS, bucket=bucket),
                      "update", every, partitions)


def read_running_sessions(spark: SparkSession, base: str, first: date | None = None,
                          last: date | None = None) -> DataFrame:
    """Running balance at the end of each hour of the days from ``first`` to ``last``.

    Two levels of sums: inside a day over its hours, and over the totals of the
    days before. A late event changes its hour and its day, nothing after them, and only the
    hours of the named days are read.
    """
    folder = f"{base}/running_sessions"
    buckets = sorted(bucket_names(spark, folder))
    low, high = (f"hour-{d.isoformat()}" if d else None for d in (first, last))
    hours = [b for b in buckets if b.startswith("hour-") and (low is None or b >= low)
             and (high is None or b <= high)]
    days = [b for b in buckets if b.startswith("day-")
            and (high is None or b <= f"day-{high[5:12]}")]
    totals = read_changes(spark, folder, RUNNING_KEYS, days)
    before = totals.select(
        F.col("window_start").alias("day"),
        (F.sum("net_change").over(W.orderBy("window_start")) - F.col("net_change")).alias("carry"))
    rows = read_changes(spark, folder, RUNNING_KEYS, hours, like=totals).withColumn(
        "day", F.date_trunc("day", "window_start"))
    inside = F.sum("net_change").over(W.partitionBy("day").orderBy("window_start"))
    return (rows.withColumn("inside", inside).join(before, "day")
            .select("window_start", "net_change",
                    (F.col("inside") + F.col("carry")).alias("active_sessions")))


# ---- distinct devices over any span ---------------------------------------------------------

DEVICE_SKETCH_KEYS = ("hour", "device_type")
# Registers of a sketch as a power of two; the error is about 1.04 / sqrt(2^14), or 0.8 %.
SKETCH_BITS = 14


def device_sketches(events: DataFrame) -> DataFrame:
    """A sketch of the device ids of each hour and device type; also on a stream."""
    return (events.filter(is_kind(LOGIN, LOGOUT) & F.col("device_id").isNotNull()
                          & F.col("event_time").isNotNull())
            .groupBy(F.date_trunc("hour", "event_time").alias("hour"), "device_type")
            .agg(F.hll_sketch_agg("device_id", SKETCH_BITS).alias("sketch")))


def start_device_sketches(events: DataFrame, base: str, every: str | None = jobs.METRICS_TRIGGER,
                          partitions: int | None = None) -> StreamingQuery:
    """Keep a mergeable sketch per hour and device type; see ``read_unique_devices``."""
    return jobs.start(device_sketches(events), "device_sketches", base,
                      changes_sink(f"{base}/device_sketches", DEVICE_SKETCH_KEYS,
                                   bucket=date_bucket("hour")), "update", every, partitions)


def read_unique_devices(spark: SparkSession, base: str, start: datetime | None = None,
                        end: datetime | None = None) -> DataFrame:
    """About how many devices of each type were seen from ``start`` to before ``end``.

    Full hours; only the dates of the span are read, and one sketch per hour.
    """
    folder = f"{base}/device_sketches"
    dates = [b for b in bucket_names(spark, folder)
             if (start is None or b >= start.strftime("%Y-%m-%d"))
             and (end is None or b <= end.strftime("%Y-%m-%d"))]
    rows = read_changes(spark, folder, DEVICE_SKETCH_KEYS, dates)
    for bound, keep in ((start, "hour >= {}"), (end, "hour < {}")):
        if bound is not None:
            rows = rows.filter(keep.format(f"timestamp'{bound:%Y-%m-%d %H:%M:%S}'"))
    return rows.groupBy("device_type").agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("unique_devices"))
