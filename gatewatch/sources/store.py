"""Event store: routed events as one Parquet folder, split by table and date.

The folders are table, date and batch: a question about one table lists that
table only, and a time bound opens only its dates.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gatewatch.operators import ingest, metrics, store_queries, users
from gatewatch.schema import (
    EVENT_COLUMNS,
    FLAT_SCHEMA,
    LOGIN,
    LOGOUT,
    REGISTRATION,
    SUSPICIOUS,
    UNKNOWN,
)
from gatewatch.sources.folders import (
    is_folder,
    read_texts,
    remove_folder,
    sub_folders,
    write_text,
)

LOGIN_EVENTS = "login_events"
SECURITY_EVENTS = "security_events"
REGISTRATIONS = "registrations"
SYSTEM_ERRORS = "system_errors"
# Hidden folder of the notes about dates whose batches are being joined.
NOTES = "_compaction"

ERROR_COLUMNS = ["error_type", "details", "event_data"]

# Bloom filters of the users of each row group, as large as these are many.
USER_FILTER = {"parquet.bloom.filter.enabled#user_id": "true",
               "parquet.bloom.filter.adaptive.enabled": "true"}

# Stated, so that opening the store looks into no file.
STORE_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    *FLAT_SCHEMA.fields,
    *[T.StructField(n, T.StringType()) for n in ERROR_COLUMNS],
    T.StructField("table", T.StringType()),
    T.StructField("event_date", T.DateType()),
    T.StructField("batch", T.LongType()),
])


def with_event_id(messages: DataFrame) -> DataFrame:
    """A unique id per message; from partition and offset unless there is one."""
    if "event_id" in messages.columns:
        return messages
    return messages.withColumn(
        "event_id", F.shiftleft(F.col("partition").cast("bigint"), 48) + F.col("offset"))


def routed_rows(messages: DataFrame, default_time: Column | None = None,
                unknown: bool = False) -> DataFrame:
    """Every message to keep, with the table it belongs to.

    Messages of no known kind are dropped, or kept without a table if ``unknown``.
    A message without a time gets the broker's, else ``default_time``, else the
    current time; a rejected one is dated in the same way. An empty failure
    reason counts as missing.

    Valid events and rejected messages share one projection, so the messages
    are parsed once and written once.
    """
    text = F.col("value").cast("string")
    default_time = F.current_timestamp() if default_time is None else default_time
    rows = ingest.checked(with_event_id(messages).withColumn("event_data", text),
                          default=default_time)
    rejected = F.col("error_type").isNotNull()
    stamps = ["event_time", *(["broker_time"] if "broker_time" in rows.columns else [])]
    dated = F.to_date(F.coalesce(*stamps, default_time.cast("timestamp")))
    if not unknown:
        rows = rows.filter(rejected | (F.col("route") != UNKNOWN))
    rows = rows.withColumns({
        "table": F.when(rejected, SYSTEM_ERRORS)
                  .when(F.col("route").isin(LOGIN, LOGOUT), LOGIN_EVENTS)
                  .when(F.col("route") == SUSPICIOUS, SECURITY_EVENTS)
                  .when(F.col("route") == REGISTRATION, REGISTRATIONS),
        "problem": F.col("error_type"),
        "problem_details": F.col("details"),
        "event_data": F.when(rejected, F.col("event_data")),
        "failure_reason": F.nullif(F.col("failure_reason"), F.lit("")),
        "dated": dated,
    })
    flat = ingest.flatten(rows)
    return flat.select(
        "table", "event_id", *EVENT_COLUMNS,
        F.col("problem").alias("error_type"), F.col("problem_details").alias("details"),
        "event_data", F.col("dated").alias("event_date"))


class EventStore:
    """The stored tables and the questions asked of them."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def append(self, messages: DataFrame, batch: int, rebalance: bool = True,
               default_time: Column | None = None) -> None:
        """Store one batch of messages; a repeated batch replaces itself.

        See ``append_rows``.
        """
        self.append_rows(routed_rows(messages, default_time), batch, rebalance)

    def append_rows(self, rows: DataFrame, batch: int, rebalance: bool = True) -> None:
        """Store one batch of rows as ``routed_rows`` gives them.

        Only the folders of this batch are overwritten. The rebalance keeps the
        files of a date together, and lets AQE split a date that holds far more
        rows than others; a load whose input is in time order already can save
        that shuffle. Rows are sorted by user inside the files, so a question
        about one user skips most row groups by their ends, and by a Bloom filter
        those between whose ends the user would fall.
        """
        rows = rows.withColumn("batch", F.lit(batch).cast("bigint"))
        if rebalance:
            rows = rows.hint("rebalance", "table", "event_date")
        (rows.sortWithinPartitions("table", "event_date", "batch", "user_id")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .options(**USER_FILTER)
         .partitionBy("table", "event_date", "batch").parquet(self.path))

    def compact(self, before: date, at_once: int = 8) -> int:
        """Join the batches of each date before ``before``; returns how many dates changed.

        ``at_once`` tables and dates are joined side by side, as each is a small job.

        The joined rows are a new batch, numbered below zero. Two notes in a hidden
        folder make the change of one date whole, wherever the driver dies: while there is
        only the note that it has begun, readers leave out the new batch; from
        the moment that the note of its end is written (one small file), they leave out
        the batches that it replaces. The next call takes back what was begun and completes
        what had ended. For closed dates and between appends: a reader that has begun may
        miss files, and a batch that was joined must not be appended again.
        """
        for note in self._notes():
            self._settle(note)
        closed = [(table, day) for table in sub_folders(self.spark, self.path)
                  if table.startswith("table=")
                  for day in sub_folders(self.spark, f"{self.path}/{table}")
                  if day.split("=", 1)[1] < before.isoformat()]
        with ThreadPoolExecutor(at_once) as workers:
            return sum(workers.map(lambda place: self._compact_day(*place), closed))

    def _compact_day(self, table: str, day: str) -> bool:
        folder = f"{self.path}/{table}/{day}"
        batches = [int(b.split("=", 1)[1]) for b in sub_folders(self.spark, folder)]
        if len(batches) < 2:
            return False
        # The newest batch inside, or of what an earlier call has joined, gives the number.
        joined = -1 - max(max(batches), *(-1 - b for b in batches))
        if joined in batches:  # nothing newer than what was joined; take the next free one
            joined = min(batches) - 1
        note = {"table": table, "day": day, "joined": joined, "replaces": sorted(batches)}
        name = f"{self.path}/{NOTES}/{table}.{day}"
        write_text(self.spark, f"{name}.begun", json.dumps(note))
        rows = self.spark.read.schema(STORE_SCHEMA).parquet(
            *[f"{folder}/batch={b}" for b in batches])
        (rows.drop("table", "event_date", "batch").hint("rebalance")
         .sortWithinPartitions("user_id").write.mode("overwrite").options(**USER_FILTER)
         .parquet(f"{folder}/batch={joined}"))
        write_text(self.spark, f"{name}.ended", json.dumps(note))
        self._settle(note | {"ended": True})
        return True

    def _notes(self) -> list[dict]:
        """Changes of dates that are not complete, with ``ended`` for what already counts."""
        found: dict[tuple, dict] = {}
        for path, text in read_texts(self.spark, f"{self.path}/{NOTES}/*").items():
            try:
                note = json.loads(text)
            except ValueError:  # the driver died while it wrote the note
                continue
            known = found.setdefault((note["table"], note["day"]), note | {"ended": False})
            known["ended"] |= path.endswith(".ended")
        return list(found.values())

    def _settle(self, note: dict) -> None:
        """Complete a change that has ended, or take back one that has only begun."""
        folder = f"{self.path}/{note['table']}/{note['day']}"
        name = f"{self.path}/{NOTES}/{note['table']}.{note['day']}"
        for batch in note["replaces"] if note["ended"] else [note["joined"]]:
            remove_folder(self.spark, f"{folder}/batch={batch}")
        # In this order a note of the beginning is never left alone over joined rows.
        remove_folder(self.spark, f"{name}.begun")
        remove_folder(self.spark, f"{name}.ended")

    def rows(self, *tables: str) -> DataFrame:
        # Only the folders of these tables are listed at all.
        folders = [f"{self.path}/table={t}" for t in tables]
        folders = [f for f in folders if is_folder(self.spark, f)]
        if not folders:
            return self.spark.createDataFrame([], STORE_SCHEMA).drop("batch")
        rows = (self.spark.read.schema(STORE_SCHEMA).option("basePath", self.path)
                .parquet(*folders))
        for note in self._notes():
            hidden = note["replaces"] if note["ended"] else [note["joined"]]
            table, day = (note[k].split("=", 1)[1] for k in ("table", "day"))
            gone = ((F.col("table") == table) & F.col("batch").isin(hidden)
                    & (F.col("event_date") == F.lit(day).cast("date")))
            rows = rows.filter(~F.coalesce(gone, F.lit(False)))
        return rows.drop("batch")

    def table(self, name: str) -> DataFrame:
        return self.rows(name).drop("table")

    def login_events(self) -> DataFrame:
        return self.table(LOGIN_EVENTS).drop(*ERROR_COLUMNS)

    def security_events(self) -> DataFrame:
        return self.table(SECURITY_EVENTS).select(
            "event_id", "event_time", "event_date", "user_id", "event_type", "device_id",
            "device_type", "os_type", "activity_type", "risk_level",
            "city", "latitude", "longitude")

    def system_errors(self) -> DataFrame:
        return self.table(SYSTEM_ERRORS).select(
            "event_id", *ERROR_COLUMNS, "city", "latitude", "longitude",
            F.col("event_time").alias("timestamp"))

    def users(self) -> DataFrame:
        return users.users_table(self.rows(LOGIN_EVENTS, REGISTRATIONS))

    def metrics(self, as_of: str | datetime, buckets: Sequence[float]) -> DataFrame:
        """Metric snapshot of the stored events and errors.

        Counters of events have names of their own here: they leave out what was
        rejected, which the counters over all decoded messages include.
        """
        events = self.rows(LOGIN_EVENTS, SECURITY_EVENTS, REGISTRATIONS)
        return metrics.metrics_snapshot(events, as_of, buckets, self.table(SYSTEM_ERRORS),
                                        prefix="stored_")

    def login_metrics(self) -> dict[str, DataFrame]:
        events = self.login_events()
        return {
            "login_attempts_by_method": store_queries.attempts_by_method(events),
            "device_distribution": store_queries.device_distribution(events),
            "location_distribution": store_queries.location_distribution(events),
        }

    def security_metrics(self, as_of: str | datetime) -> DataFrame:
        return store_queries.recent_failures(self.login_events(), as_of)

    def login_history(self, user_id: str, start=None, end=None) -> DataFrame:
        return store_queries.login_history(self.login_events(), user_id, start, end)

    def active_sessions(self, successful_only: bool = False) -> DataFrame:
        return store_queries.active_sessions(self.login_events(), successful_only)
