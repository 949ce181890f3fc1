"""Rows of a key in order of time on a stream: the streaming twin of ``lag_by_key``.

Two stateful operators follow each other. The first gathers the rows of a key and
time slot in the state store and lets them go once the watermark has passed the slot, so
rows may come in any order, over any number of micro-batches, within the delay. The second
keeps the last rows of each key and adds them in front of the next slots. What
crosses into Python is one row per key and slot, whose rows are a text that is only
passed on.
"""

from __future__ import annotations

import pickle
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from gatewatch.sources.folders import make_folder

DELAY = "10 minutes"
SLOT = "1 minute"
# Buckets of keys that share an entry of the state; fixed by the first checkpoint.
BUCKETS = 8192
TICK_SCHEMA = "at timestamp"


def tick_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Times that ``tick`` writes; they move the watermark of a stream without events."""
    make_folder(spark, folder)
    return spark.readStream.schema(TICK_SCHEMA).parquet(folder)


def tick(spark: SparkSession, folder: str, at: datetime) -> None:
    """Say that no event before ``at`` is to come; what waits for it is let go."""
    (spark.createDataFrame([(at,)], TICK_SCHEMA).coalesce(1)
     .write.mode("append").parquet(folder))


def _stored(field: T.StructField) -> Column:
    """A column as it goes into JSON: times as microseconds, which JSON texts keep whole."""
    column = F.col(f"`{field.name}`")
    return (F.unix_micros(column) if isinstance(field.dataType, T.TimestampType)
            else column).alias(field.name)


def _stored_schema(fields: Sequence[T.StructField]) -> T.StructType:
    return T.StructType([
        T.StructField(f.name, T.LongType() if isinstance(f.dataType, T.TimestampType)
                      else f.dataType) for f in fields])


def _read(column: Column, field: T.StructField) -> Column:
    return F.timestamp_micros(column) if isinstance(field.dataType, T.TimestampType) else column


def carrying(columns: Sequence[str], offset: int, keep_ms: int | None) -> StatefulProcessor:
    """Keeps the last ``offset`` rows of each key of a bucket, as lines of text; built here
    to travel to the workers by value.

    ``columns`` are those of its result: the key, the lines carried, and what is passed on.
    """
    key_col, passed = columns[0], columns[2:]

    class Carry(StatefulProcessor):
        def init(self, handle) -> None:
            self.last = handle.getValueState("last", "tails binary")
            self.handle = handle

        def tails(self, known) -> dict:
            """Key -> its last rows, and the time from which on they are forgotten."""
            return pickle.loads(bytes(known[0])) if known else {}

        def keep(self, tails: dict, now: int | None) -> None:
            if now is not None:
                tails = {k: v for k, v in tails.items() if v[1] > now}
            self.last.update((pickle.dumps(tails),))

        def handleInputRows(self, key, rows, timerValues):
            from pyspark.sql import Row
            known = self.last.get()
            tails, now = self.tails(known), None
            if keep_ms is not None:
                now = timerValues.getCurrentWatermarkInMs()
                if not known:
                    self.handle.registerTimer(now + keep_ms)
            made = Row(*columns)
            for row in sorted(rows, key=lambda r: r["end_ms"]):
                carry, until = tails.get(row[key_col], ("", 0))
                if keep_ms is not None and row["end_ms"] > until:
                    carry = ""  # whether or not the timer has come to it
                yield made(row[key_col], carry, *(row[c] for c in passed))
                # Forgotten if the next slot starts more than ``keep_ms`` after this one's end.
                lines = row["tail"].split("\n")
                if len(lines) < offset and carry:
                    lines = [*carry.split("\n"), *lines][-offset:]
                tails[row[key_col]] = ("\n".join(lines),
                                       row["end_ms"] + row["slot_ms"] + (keep_ms or 0))
            self.keep(tails, now)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            now = timerValues.getCurrentWatermarkInMs()
            tails = self.tails(self.last.get())
            if any(until > now for _, until in tails.values()):
                self.keep(tails, now)
                self.handle.registerTimer(now + keep_ms)
            else:
                self.last.clear()
            return iter(())

        def close(self) -> None:
            pass

    return Carry()


def lag_stream(df: DataFrame, key: str, order: Sequence[str], lags: dict[str, str],
               offset: int = 1, delay: str = DELAY, slot: str = SLOT,
               ticks: DataFrame | None = None, keep_seconds: int | None = None,
               chained: bool = False, buckets: int = BUCKETS) -> DataFrame:
    """``df`` with ``lags``, ``offset`` rows back per key, each row once and in append mode.

    As ``lag_by_key`` over all rows that come within ``delay`` of the newest event
    time; rows that come later are left out and counted by Spark. Rows without a key or
    time have no result. A row comes out once the watermark has passed its slot;
    ``ticks`` (see ``tick_stream``) move it on where no events come. With ``keep_seconds`` a
    key whose slots lie further apart is forgotten between them: lags of that reach are
    whole, longer ones null, and the state holds no key much longer than that. With
    ``chained`` there is a column ``slot_end``, by which another aggregation in the same
    query can wait for the watermark.

    The last rows are kept for ``buckets`` of keys, as a key's looks into the state from
    Python cost much more than passing a slot on; a bucket with news is written as a whole.
    """
    time = order[0]
    fields = {f.name: f for f in df.schema.fields}
    others = [f for n, f in fields.items() if n not in order]
    stored = [*(fields[n] for n in order), *others]
    rows = df if ticks is None else df.unionByName(
        ticks.select(F.col("at").alias(time)), allowMissingColumns=True)
    # Ticks are a group without rows: a filter on the key would be pushed
    # below the watermark and take their effect away.
    row = F.when(F.col(f"`{key}`").isNotNull(), F.struct(*(_stored(f) for f in stored)))
    sources = list(dict.fromkeys(lags.values()))
    tail = F.slice("rows", F.greatest(F.size("rows") - offset + 1, F.lit(1)), F.lit(offset))
    # Python takes a row column by column, so there are few and simple ones: JSON texts have
    # no line ends, so they are lines of one text, and one time shows the watermark.
    slots = (rows.withWatermark(time, delay)
             .groupBy(f"`{key}`", F.window(time, slot))
             .agg(F.array_sort(F.collect_list(row)).alias("rows"))
             .filter(F.size("rows") > 0)
             .select(F.pmod(F.xxhash64(f"`{key}`"), F.lit(buckets)).cast("int").alias("_bucket"),
                     f"`{key}`", F.window_time("window").alias("slot_time"),
                     (F.unix_millis("window.end") - F.unix_millis("window.start"))
                     .alias("slot_ms"),
                     F.unix_millis("window.end").alias("end_ms"),
                     F.to_json("rows").alias("rows"),
                     F.array_join(F.transform(tail, lambda r: F.to_json(
                         F.struct(*(r[s].alias(s) for s in sources)))), "\n").alias("tail")))
    timed = chained or keep_seconds is not None
    output = T.StructType([fields[key], T.StructField("carry", T.StringType()),
                           T.StructField("rows", T.StringType()),
                           *([T.StructField("slot_time", T.TimestampType())] if chained else [])])
    keep_ms = None if keep_seconds is None else keep_seconds * 1000
    carried = slots.groupBy("_bucket").transformWithState(
        carrying(output.names, offset, keep_ms), output, "Append",
        "EventTime" if timed else "None", eventTimeColumnName="slot_time" if chained else "")
    names = ["slot_end"] if chained else []
    ends = [F.col("slot_time").alias("slot_end")] if chained else []
    seen = _stored_schema([fields[s] for s in sources])
    before = F.transform(F.filter(F.split("carry", "\n"), lambda c: c != ""),
                         lambda c: F.from_json(c, seen))
    inside = F.from_json("rows", T.ArrayType(_stored_schema(stored)))
    found = (carried.select(*ends, before.alias("before"), inside.alias("inside"))
             .select(*names, "inside", F.size("before").alias("n"), F.concat(
                 "before", F.transform("inside", lambda r: F.struct(
                     *(r[s].alias(s) for s in sources)))).alias("all"))
             .select(*names, F.inline(F.transform("inside", lambda r, i: F.struct(
                 r.alias("row"), F.get("all", i + F.col("n") - offset).alias("lagged"))))))
    return found.select(
        *[_read(F.col("row")[n], f).alias(n) for n, f in fields.items()],
        *[_read(F.col("lagged")[s], fields[s]).alias(n) for n, s in lags.items()],
        *names)
