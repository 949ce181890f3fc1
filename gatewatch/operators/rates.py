"""Success-rate and failure tables over login events.

Every table is one partial aggregation, a shuffle of one row per group and
task, and a final aggregation, so a hot group never reaches one task row by row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewatch.functions import is_kind, success_count
from gatewatch.schema import LOGIN

COMBO_KEYS = ("city", "device_type", "login_method")

# Result table name -> grouping keys.
RATE_TABLES = {
    "combo_metrics": COMBO_KEYS,
    "city_metrics": ("city",),
    "method_metrics": ("login_method",),
    "device_metrics": ("device_type",),
}


def _key(name: str) -> Column:
    source = "authentication_method" if name == "login_method" else name
    return F.col(source).alias(name)


def with_rates(counts: DataFrame) -> DataFrame:
    """Add failed_attempts and success_rate to total and successful counts."""
    total, good = F.col("total_attempts"), F.col("successful_attempts")
    return (counts
            .withColumn("failed_attempts", total - good)
            .withColumn("success_rate", F.round(good * F.lit(100.0) / total, 2)))


def login_counts(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    return (events.filter(is_kind(LOGIN))
            .groupBy(*[_key(k) for k in keys])
            .agg(F.count(F.lit(1)).alias("total_attempts"),
                 success_count().alias("successful_attempts")))


def login_rates(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attempts, successes, failures and success rate per key combination."""
    return with_rates(login_counts(events, keys))


def failure_counts(events: DataFrame) -> DataFrame:
    """Failed logins per reason; a NULL ``success`` is not a failure here."""
    return (events.filter(is_kind(LOGIN) & ~F.col("success"))
            .groupBy(F.col("failure_reason").alias("reason"))
            .agg(F.count(F.lit(1)).alias("count")))


def roll_up(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rate table for fewer keys from already counted combinations."""
    return with_rates(counts.groupBy(*keys)
                      .agg(F.sum("total_attempts").alias("total_attempts"),
                           F.sum("successful_attempts").alias("successful_attempts")))


def login_rate_grouping_sets(events: DataFrame) -> DataFrame:
    """All four rate tables in one scan.

    The events are counted per full combination first; the grouping sets then
    expand those few combinations instead of every event. ``grouping_id`` keeps
    a NULL key apart from a key that was rolled up.
    """
    counts = login_counts(events, COMBO_KEYS)
    sets = [[F.col(k) for k in keys] for keys in RATE_TABLES.values()]
    return with_rates(
        counts.groupingSets(sets, *[F.col(k) for k in COMBO_KEYS])
        .agg(F.grouping_id(*COMBO_KEYS).cast("bigint").alias("grouping_id"),
             F.sum("total_attempts").alias("total_attempts"),
             F.sum("successful_attempts").alias("successful_attempts")))
