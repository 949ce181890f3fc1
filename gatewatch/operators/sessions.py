"""Session durations and activity trends."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gatewatch.functions import is_kind, seconds_between
from gatewatch.operators.skew import SLOT_SECONDS, Lag, lag_by_key
from gatewatch.schema import LOGIN, LOGOUT


def session_marks(events: DataFrame) -> DataFrame:
    """Rows that open or close a session: successful logins and logouts.

    Rows without a user or a time belong to no session.
    """
    return (events.filter(F.col("user_id").isNotNull() & F.col("event_time").isNotNull())
            .filter((is_kind(LOGIN) & F.col("success")) | is_kind(LOGOUT))
            .select("event_id", "user_id", "event_time", "event_type", "device_type"))


def session_durations(events: DataFrame, slot_seconds: int = SLOT_SECONDS,
                      lag: Lag | None = None, also: Sequence[str] = ()) -> DataFrame:
    """Seconds since the user's latest successful login, per logout.

    NULL where no login precedes the logout or another logout came in between. On a
    stream ``lag`` is the streaming lag, and ``also`` names columns of its result to keep.
    """
    lag = partial(lag_by_key, slot_seconds=slot_seconds) if lag is None else lag
    marks = lag(session_marks(events), "user_id", ["event_time", "event_id"],
                {"prev_type": "event_type", "prev_time": "event_time"})
    return (marks.filter(is_kind(LOGOUT))
            .select("event_id", "user_id", "event_time", "device_type", *also,
                    F.when(F.col("prev_type") == LOGIN,
                           seconds_between(F.col("prev_time"), F.col("event_time")))
                     .alias("session_duration")))


def activity_trend(events: DataFrame, width: str = "1 hour") -> DataFrame:
    """Events per time window and kind; usable on a stream as well."""
    return (events.groupBy(F.window("event_time", width), "event_type")
            .agg(F.count(F.lit(1)).alias("events"))
            .select(F.col("window.start").alias("window_start"), "event_type", "events"))


def active_sessions_trend(events: DataFrame, width: str = "hour") -> DataFrame:
    """Running balance of logins and logouts at the end of each time step.

    Only the per-step balances, one row per hour of history, reach the
    unpartitioned window.
    """
    steps = (events.filter(is_kind(LOGIN, LOGOUT))
             .groupBy(F.date_trunc(width, "event_time").alias("window_start"))
             .agg(F.sum(F.when(is_kind(LOGIN), 1).otherwise(-1)).alias("net_change")))
    running = W.orderBy("window_start").rowsBetween(W.unboundedPreceding, W.currentRow)
    return steps.withColumn("active_sessions", F.sum("net_change").over(running))
