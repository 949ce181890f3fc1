"""Simple anomaly rules over logins, and the reported suspicious events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewatch.functions import has_location, is_kind, seconds_between
from gatewatch.operators.skew import Lag, lag_by_key
from gatewatch.schema import LOGIN, SUSPICIOUS

ORDER = ("event_time", "event_id")


def _user_logins(events: DataFrame) -> DataFrame:
    return events.filter(is_kind(LOGIN) & F.col("user_id").isNotNull())


def multiple_failed_attempts(events: DataFrame, attempts: int = 2,
                             span_seconds: int = 86400, lag: Lag = lag_by_key) -> DataFrame:
    """Failed logins that are at least the ``attempts``-th within the span.

    That is the case exactly if the failure ``attempts - 1`` places earlier is
    not older than the span, so a lag replaces a sliding count. Here and in the rules
    below a stream names its own ``lag``.
    """
    failures = (_user_logins(events).filter(~F.col("success"))
                .select("event_id", "user_id", "event_time"))
    rows = lag(failures, "user_id", ORDER, {"first_failure": "event_time"},
               offset=attempts - 1)
    since = F.col("event_time") - F.make_dt_interval(secs=F.lit(span_seconds))
    return rows.filter(F.col("first_failure") >= since)


def failed_windows(events: DataFrame, attempts: int = 2, span: str = "24 hours",
                   slide: str = "1 hour") -> DataFrame:
    """Users with ``attempts`` or more failures in a sliding window.

    The form of the rule that a stream can run. Failures are few, and the counts
    per window are added up in the tasks before they are shuffled.
    """
    return (events.filter(is_kind(LOGIN) & ~F.col("success"))
            .groupBy(F.window("event_time", span, slide), "user_id")
            .agg(F.count(F.lit(1)).alias("failures"))
            .filter(F.col("failures") >= attempts)
            .select(F.col("window.start").alias("window_start"), "user_id", "failures"))


def unusual_location(events: DataFrame, lag: Lag = lag_by_key) -> DataFrame:
    """Logins from another city than the user's previous located login."""
    located = (_user_logins(events).filter(has_location())
               .select("event_id", "user_id", "event_time", "city"))
    rows = lag(located, "user_id", ORDER, {"previous_city": "city"})
    return rows.filter(F.col("city") != F.col("previous_city"))


def rapid_device_switch(events: DataFrame, span_seconds: int = 3600,
                        lag: Lag = lag_by_key) -> DataFrame:
    """Logins from another device than the previous login within the span."""
    logins = (_user_logins(events)
              .select("event_id", "user_id", "event_time", "device_id"))
    rows = lag(logins, "user_id", ORDER,
               {"previous_device": "device_id", "previous_time": "event_time"})
    gap = seconds_between(F.col("previous_time"), F.col("event_time"))
    return (rows.withColumn("seconds_since", gap)
            .filter((F.col("device_id") != F.col("previous_device"))
                    & (F.col("seconds_since") <= span_seconds))
            .drop("previous_time"))


def suspicious_events(events: DataFrame) -> DataFrame:
    """Stand-alone suspicious events and marks embedded in logins, one shape."""
    columns = ["event_id", "event_time", "user_id", "device_id", "city",
               "activity_type", "risk_level"]
    return (events
            .filter(is_kind(SUSPICIOUS) | (is_kind(LOGIN) & F.col("activity_type").isNotNull()))
            .select(*columns,
                    F.when(is_kind(LOGIN), "login").otherwise("standalone").alias("origin")))
