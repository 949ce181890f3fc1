"""Labelled counters, gauges, histograms and their exposition as one table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewatch.functions import is_kind
from gatewatch.operators.sessions import session_durations
from gatewatch.operators.store_queries import since
from gatewatch.operators.users import user_facts
from gatewatch.schema import LOGIN, LOGOUT, SUSPICIOUS, UNKNOWN


@dataclass(frozen=True)
class Counter:
    """Which events count, under which labels, and by how much (SQL text)."""

    rows: str
    labels: dict[str, str] = field(default_factory=dict)
    step: str = "1"


def _unknown(column: str) -> str:
    return f"coalesce({column}, '{UNKNOWN}')"


IS_LOGIN = f"event_type = '{LOGIN}'"
IS_LOGOUT = f"event_type = '{LOGOUT}'"
IN_SESSION = f"event_type IN ('{LOGIN}', '{LOGOUT}')"
# +1 for a login, -1 for a logout; sums may become negative.
SESSION_STEP = f"if({IS_LOGIN}, 1, -1)"
STATUS = "if(success, 'success', 'failure')"

# Counters and count-like gauges fed by single events. The metric and label
# names are fixed values.
COUNTERS = {
    "login_events_total": Counter(IS_LOGIN),
    "logout_events_total": Counter(IS_LOGOUT),
    "active_sessions_total": Counter(IN_SESSION, step=SESSION_STEP),
    "active_sessions_by_device": Counter(
        IN_SESSION, {"device_type": _unknown("device_type")}, SESSION_STEP),
    "login_attempts_total": Counter(
        IS_LOGIN, {"auth_method": "authentication_method", "status": STATUS}),
    # A missing outcome is a failure here; a failure without reason is not counted.
    "authentication_failures_total": Counter(
        f"{IS_LOGIN} AND NOT coalesce(success, false) AND failure_reason <> ''",
        {"auth_method": "authentication_method", "failure_reason": "failure_reason"}),
    "device_connections_total": Counter(
        IS_LOGIN, {"device_type": _unknown("device_type"), "os_type": _unknown("os_type")}),
    "suspicious_activities_total": Counter(
        f"event_type = '{SUSPICIOUS}'",
        {"activity_type": "activity_type", "risk_level": "risk_level"}),
    "suspicious_activities_by_city": Counter(
        f"event_type = '{SUSPICIOUS}'",
        {"activity_type": "activity_type", "risk_level": "risk_level",
         "city": _unknown("city")}),
    "login_locations_total": Counter(
        IS_LOGIN, {"city": _unknown("city"), "result": STATUS}),
    "logouts_total": Counter(
        IS_LOGOUT, {"device_type": _unknown("device_type"), "city": _unknown("city")}),
}

# Counts per place. Coordinates may differ with every login, so they have an
# aggregate of their own and never multiply the groups of the others.
LOCATION_GAUGES = {
    "login_locations_active": Counter(
        f"{IS_LOGIN} AND success",
        {"city": _unknown("city"),
         "latitude": "coalesce(CAST(latitude AS STRING), '0')",
         "longitude": "coalesce(CAST(longitude AS STRING), '0')"}),
}

# Counts of stored rows; they need the columns ``stored`` and ``recent``.
STORE_GAUGES = {
    "device_distribution": Counter(
        f"stored AND {IN_SESSION} AND device_type <> ''", {"device_type": "device_type"}),
    "security_alerts_current": Counter(
        f"stored AND {IN_SESSION} AND recent AND NOT success",
        {"city": "city", "reason": "nullif(failure_reason, '')"}),
}


def counter(events: DataFrame, name: str) -> DataFrame:
    """One counter or location gauge: its label columns and ``value``."""
    spec = {**COUNTERS, **LOCATION_GAUGES}[name]
    return (events.filter(spec.rows)
            .groupBy(*[F.expr(text).alias(label) for label, text in spec.labels.items()])
            .agg(F.coalesce(F.sum(F.expr(spec.step)), F.lit(0)).alias("value")))


def session_counters(events: DataFrame) -> DataFrame:
    """Logins, logouts and their balance in one row; also on a stream."""
    return (events.filter(is_kind(LOGIN, LOGOUT))
            .agg(F.count_if(is_kind(LOGIN)).alias("login_events_total"),
                 F.count_if(is_kind(LOGOUT)).alias("logout_events_total"))
            .withColumn("active_sessions_total",
                        F.col("login_events_total") - F.col("logout_events_total")))


def store_login_attempts(by_method: DataFrame) -> DataFrame:
    """Attempt counter fed from the stored totals per method."""
    return by_method.select(
        F.col("authentication_method").alias("auth_method"),
        F.inline(F.array(
            F.struct(F.lit("success").alias("status"),
                     F.col("successful_attempts").alias("value")),
            F.struct(F.lit("failure").alias("status"),
                     F.col("failed_attempts").alias("value")))))


# ---- gauges over active sessions -----------------------------------------------

TOTAL = "'total'"
# What the gauges over active sessions look at.
ACTIVE_COLUMNS = ("event_type", "device_type", "device_id")


def active_by_device(active: DataFrame) -> DataFrame:
    """Active sessions and distinct devices in use per device type."""
    return (active.groupBy("device_type")
            .agg(F.count(F.lit(1)).alias("active_sessions"),
                 F.count_distinct("device_id").alias("unique_devices")))


def concurrent_users(active: DataFrame) -> DataFrame:
    return active.agg(F.count(F.lit(1)).alias("value")).select(
        F.lit("total").alias("user_type"), "value")


# ---- histogram and summary -----------------------------------------------------

def _exact(column: Column) -> Column:
    # Decimal sums do not depend on the order in which tasks finish.
    return column.cast("decimal(24,6)")


def summary(df: DataFrame, value: str, labels: Sequence[str]) -> DataFrame:
    """Count and sum of ``value`` per label combination."""
    return (df.filter(F.col(value).isNotNull()).groupBy(*labels)
            .agg(F.count(F.lit(1)).alias("count"),
                 F.sum(_exact(F.col(value))).cast("double").alias("sum")))


def histogram_totals(df: DataFrame, value: str, labels: Sequence[str | Column],
                     buckets: Sequence[float]) -> DataFrame:
    """One row per label combination with a column per bucket, which can be added up."""
    v = F.col(value)
    within = [F.count_if(v <= b).alias(f"_le_{i}") for i, b in enumerate(buckets)]
    return (df.filter(v.isNotNull()).groupBy(*labels)
            .agg(*within, F.count(F.lit(1)).alias("count"), F.sum(_exact(v)).alias("sum")))


def add_totals(totals: DataFrame, labels: Sequence[str], buckets: Sequence[float]) -> DataFrame:
    """Totals of parts of the rows as those of all of them."""
    sums = [f"_le_{i}" for i in range(len(buckets))] + ["count", "sum"]
    return totals.groupBy(*labels).agg(*[F.sum(c).alias(c) for c in sums])


def histogram_rows(totals: DataFrame, labels: Sequence[str],
                   buckets: Sequence[float]) -> DataFrame:
    rows = [F.struct(F.lit(f"{b:g}").alias("le"), F.col(f"_le_{i}").alias("bucket"))
            for i, b in enumerate(buckets)]
    rows.append(F.struct(F.lit("+Inf").alias("le"), F.col("count").alias("bucket")))
    return totals.select(*labels, F.inline(F.array(*rows)), "count",
                         F.col("sum").cast("double").alias("sum"))


def histogram(df: DataFrame, value: str, labels: Sequence[str],
              buckets: Sequence[float]) -> DataFrame:
    """Cumulative buckets per label combination, with the count and sum.

    Each event is looked at once: the buckets are conditional sums of one
    aggregation, and only its result is turned into one row per bucket.
    """
    return histogram_rows(histogram_totals(df, value, labels, buckets), labels, buckets)


# ---- exposition ------------------------------------------------------------------

def sample(metric: str, labels: dict[str, str], value: str) -> str:
    """SQL text of one sample: metric name, label pairs, value."""
    pairs = ", ".join(f"named_struct('name', '{n}', 'value', CAST({text} AS STRING))"
                      for n, text in labels.items())
    return (f"named_struct('metric', '{metric}', "
            f"'labels', CAST(array({pairs}) AS ARRAY<STRUCT<name: STRING, value: STRING>>), "
            f"'value', CAST({value} AS DOUBLE))")


def _samples(rows: DataFrame, samples: Sequence[str]) -> DataFrame:
    """The samples of each row that are not NULL, one below the other."""
    return rows.select(F.expr(f"inline(array_compact(array({', '.join(samples)})))"))


def _summed(samples: DataFrame) -> DataFrame:
    return samples.groupBy("metric", "labels").agg(F.sum("value").alias("value"))


LABEL_SOURCES = ("event_type", "authentication_method", "success", "failure_reason",
                 "device_type", "os_type", "city", "activity_type", "risk_level")
# What the location gauge looks at.
PLACE_SOURCES = ("event_type", "success", "city", "latitude", "longitude")


def label_counts(events: DataFrame) -> DataFrame:
    """Events per combination of everything a counter can be labelled with.

    Labels have few values by nature, so one scan reduces the events to a small
    table from which all counters follow; also on a stream.
    """
    return (events.select(*LABEL_SOURCES).groupBy(*LABEL_SOURCES)
            .agg(F.count(F.lit(1)).alias("n")))


def place_counts(events: DataFrame) -> DataFrame:
    """Successful logins per place; also on a stream."""
    return (events.filter(LOCATION_GAUGES["login_locations_active"].rows)
            .select(*PLACE_SOURCES).groupBy(*PLACE_SOURCES)
            .agg(F.count(F.lit(1)).alias("n")))


def label_and_place_counts(events: DataFrame, as_of: str | datetime,
                           hours: int = 24) -> DataFrame:
    """Both tables of counts from one scan, told apart by ``places``.

    A boolean column ``stored`` of the events says which of them the gauges over
    stored rows count; without one, all.
    """
    stored = F.col("stored") if "stored" in events.columns else F.lit(True)
    labels = [*LABEL_SOURCES, "stored", "recent"]
    both = sorted({*labels, *PLACE_SOURCES})
    rows = events.select(
        *LABEL_SOURCES, "latitude", "longitude", stored.alias("stored"),
        (F.col("event_time") >= since(as_of, hours)).alias("recent"))
    sets = [[F.col(c) for c in labels], [F.col(c) for c in PLACE_SOURCES]]
    return (rows.groupingSets(sets, *both)
            .agg(F.count(F.lit(1)).alias("n"), F.grouping("os_type").alias("places")))


def _counter_sql(specs: dict[str, Counter], rows: str = "true", prefix: str = "") -> list[str]:
    return [f"if({rows} AND {c.rows}, {sample(prefix + name, c.labels, f'n * {c.step}')}, NULL)"
            for name, c in specs.items()]


def counter_samples(counts: DataFrame) -> DataFrame:
    """Samples of every counter from ``label_counts``."""
    return _summed(_samples(counts, _counter_sql(COUNTERS)))


def place_samples(counts: DataFrame) -> DataFrame:
    """Samples of the location gauge from ``place_counts``."""
    return _summed(_samples(counts, _counter_sql(LOCATION_GAUGES)))


def session_gauges(by_device: DataFrame) -> DataFrame:
    """Samples of ``active_by_device`` rows."""
    device = {"device_type": "device_type"}
    return _summed(_samples(by_device, [
        sample("active_sessions_current", device, "active_sessions"),
        sample("unique_devices_active", device, "unique_devices"),
        sample("concurrent_users_current", {"user_type": TOTAL}, "active_sessions"),
    ]))


def user_samples(facts: DataFrame) -> DataFrame:
    """Gauges over active sessions and accounts from ``users.user_facts``, read once."""
    device = {"device_type": "device_type"}
    active = F.coalesce(F.col("last_type") == LOGIN, F.lit(False))
    rows = facts.select(active.alias("active"), "device_type", "device_id", "known",
                        "account_status")
    counts = (rows.groupingSets([[F.col("active"), F.col("device_type")],
                                 [F.col("known"), F.col("account_status")]],
                                "active", "device_type", "known", "account_status")
              .agg(F.count(F.lit(1)).alias("n"),
                   F.count_distinct("device_id").alias("devices"),
                   F.grouping("known").alias("sessions")))
    session = "sessions = 1 AND active"
    return _summed(_samples(counts, [
        f"if({session}, {sample('active_sessions_current', device, 'n')}, NULL)",
        f"if({session}, {sample('unique_devices_active', device, 'devices')}, NULL)",
        f"if({session}, {sample('concurrent_users_current', {'user_type': TOTAL}, 'n')}, NULL)",
        f"if(sessions = 0 AND known, "
        f"{sample('user_status_current', {'status': 'account_status'}, 'n')}, NULL)",
    ]))


def histogram_samples(hist: DataFrame, metric: str, labels: Sequence[str]) -> DataFrame:
    label = {n: n for n in labels}
    return _samples(hist, [
        sample(f"{metric}_bucket", {**label, "le": "le"}, "bucket"),
        f"if(le = '+Inf', {sample(f'{metric}_count', label, 'count')}, NULL)",
        f"if(le = '+Inf', {sample(f'{metric}_sum', label, 'sum')}, NULL)",
    ])


def table_samples(df: DataFrame, metric: str, labels: Sequence[str], value: str) -> DataFrame:
    """Samples of a finished table with label columns and one value column."""
    return _samples(df, [sample(metric, {n: n for n in labels}, value)])


def with_label_map(samples: DataFrame) -> DataFrame:
    return samples.select("metric", F.map_from_entries("labels").alias("labels"), "value")


def errors_total(errors: DataFrame) -> DataFrame:
    return errors.groupBy("error_type").agg(F.count(F.lit(1)).alias("value"))


def metrics_snapshot(events: DataFrame, as_of: str | datetime, buckets: Sequence[float],
                     errors: DataFrame | None = None, prefix: str = "") -> DataFrame:
    """Every metric as rows of metric, labels and value.

    Three scans of the events: all counts, one row per user, and the session
    durations. A boolean column ``stored`` tells which events the gauges over stored
    rows see; ``prefix`` goes before the names of the event counters.
    """
    stored = events.filter("stored") if "stored" in events.columns else events
    durations = histogram(session_durations(events), "session_duration",
                          ["device_type"], buckets)
    parts = [
        _summed(_samples(label_and_place_counts(events, as_of), [
            *_counter_sql(COUNTERS, "places = 0", prefix),
            *_counter_sql(STORE_GAUGES, "places = 0"),
            *_counter_sql(LOCATION_GAUGES, "places = 1", prefix)])),
        user_samples(user_facts(stored)),
        histogram_samples(durations, "session_duration_seconds", ["device_type"]),
    ]
    if errors is not None:
        parts.append(table_samples(errors_total(errors), "errors_total",
                                   ["error_type"], "value"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return with_label_map(out)
