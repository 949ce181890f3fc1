"""Message decoding, routing, validation and the message constructors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gatewatch.functions import event_time_from, iso_text, or_unknown
from gatewatch.schema import (
    CORRUPT_COLUMN,
    EVENT_COLUMNS,
    EVENT_SCHEMA,
    LOGIN,
    LOGOUT,
    REGISTRATION,
    SUSPICIOUS,
    UNKNOWN,
)

MALFORMED = "malformed_json"
MISSING_FIELD = "missing_field"
BAD_TIMESTAMP = "bad_timestamp"


def envelope(messages: DataFrame) -> DataFrame:
    """Topic, partition, offset, broker time and text value of Kafka rows."""
    return messages.select("topic", "partition", "offset", "timestamp",
                           F.col("value").cast("string").alias("value"))


def decode(messages: DataFrame, value: str = "value",
           fields: Sequence[str] | None = None) -> DataFrame:
    """Parse the JSON text once and expose the message fields as columns.

    Other columns of ``messages`` are kept, except those a message field
    replaces; the broker's ``timestamp`` becomes ``broker_time``. ``malformed`` is true for
    text that is not a JSON object; a wrong type in one field only nulls that
    field. With ``fields`` only these are parsed, which is cheaper: the others
    are NULL and broken text is a row of NULLs.

    The parsed struct goes through ``inline``: filters on its fields then stay
    above the parser instead of being pushed below it, where they would parse
    the text again for every field they look at.
    """
    names = EVENT_SCHEMA.fieldNames()
    kept = [c for c in messages.columns if c not in names]
    if "timestamp" in messages.columns and (
            messages.schema["timestamp"].dataType == T.TimestampType()):
        messages = messages.withColumn("broker_time", F.col("timestamp"))
        kept = [*kept, "broker_time"]
    text = F.col(value).cast("string")
    if fields is not None:
        schema = T.StructType([f for f in EVENT_SCHEMA.fields if f.name in fields])
        parsed = messages.select(*kept, F.inline(F.array(F.from_json(text, schema))))
        return parsed.withColumns({
            f.name: F.lit(None).cast(f.dataType) for f in EVENT_SCHEMA.fields
            if f.name not in fields and f.name != CORRUPT_COLUMN})
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}
    parsed = messages.select(*kept, F.inline(F.array(F.from_json(text, EVENT_SCHEMA, options))))
    corrupt = F.col(CORRUPT_COLUMN)
    is_object = F.coalesce(F.get_json_object(corrupt, "$").startswith("{"), F.lit(False))
    return (parsed
            .withColumn("malformed", text.isNull() | (F.trim(text) == "")
                        | (corrupt.isNotNull() & ~is_object))
            .drop(CORRUPT_COLUMN))


def with_default_timestamp(messages: DataFrame, default: Column | None = None) -> DataFrame:
    """Fill a missing ``timestamp`` text, by default with the current time."""
    default = F.current_timestamp() if default is None else default
    return messages.withColumn("timestamp", F.coalesce("timestamp", iso_text(default)))


def is_missing(text: Column) -> Column:
    return text.isNull() | (F.trim(text) == "")


def with_event_time(messages: DataFrame, default: Column | None = None) -> DataFrame:
    """Event time: that of the message, else the broker's, else ``default``.

    A time that is there but cannot be read stays NULL, so that the message can be
    rejected instead of getting a wrong time.
    """
    text = F.col("timestamp")
    others = [F.col("broker_time")] if "broker_time" in messages.columns else []
    others += [] if default is None else [default.cast("timestamp")]
    found = event_time_from(text)
    if others:
        found = F.when(is_missing(text), F.coalesce(*others)).otherwise(found)
    return messages.withColumn("event_time", found)


def with_route(messages: DataFrame) -> DataFrame:
    """Tag each message with its kind.

    The event type is looked at before the registration mark, and a message
    that fits none of the kinds is ``unknown``.
    """
    return messages.withColumn("route", F.expr(f"""
        CASE WHEN event_type IN ('{LOGIN}', '{LOGOUT}', '{SUSPICIOUS}') THEN event_type
             WHEN user_id IS NOT NULL AND registration IS NOT NULL THEN '{REGISTRATION}'
             ELSE '{UNKNOWN}' END"""))


# Fields each kind must carry, in the order in which they are looked up.
REQUIRED_FIELDS = {
    LOGIN: ("user_id", "device_info", "authentication_method", "success"),
    LOGOUT: ("user_id", "device_info"),
    SUSPICIOUS: ("user_id", "device_info", "activity_type", "risk_level"),
    REGISTRATION: ("username", "account_type", "device_info.device_id"),
}


def with_validity(routed: DataFrame) -> DataFrame:
    """Add ``error_type`` and ``details``; both are NULL for a valid message."""
    def first_missing(fields: tuple[str, ...]) -> str:
        tests = " ".join(f"WHEN {f} IS NULL THEN '{f}'" for f in fields)
        return f"CASE {tests} END"

    bad_time = (f"route <> '{UNKNOWN}' AND event_time IS NULL "
                "AND trim(coalesce(timestamp, '')) <> ''")
    missing = "CASE route " + " ".join(
        f"WHEN '{kind}' THEN {first_missing(fields)}"
        for kind, fields in REQUIRED_FIELDS.items()) + " END"
    return (routed
            .withColumn("missing", F.expr(missing))
            .selectExpr("* EXCEPT (missing)", f"""
                CASE WHEN malformed THEN '{MALFORMED}'
                     WHEN missing IS NOT NULL THEN '{MISSING_FIELD}'
                     WHEN {bad_time} THEN '{BAD_TIMESTAMP}' END AS error_type""", f"""
                CASE WHEN malformed THEN 'not a JSON object'
                     WHEN missing IS NOT NULL THEN concat('missing ', missing)
                     WHEN {bad_time} THEN 'unreadable timestamp' END AS details"""))


def checked(messages: DataFrame, value: str = "value",
            default: Column | None = None) -> DataFrame:
    """Decode, derive the event time, route and validate in one projection."""
    return with_validity(with_route(with_event_time(decode(messages, value), default)))


def flatten(messages: DataFrame) -> DataFrame:
    """Nested message fields to the canonical flat event columns."""
    helpers = ("value", "malformed", "route", "error_type", "details", "broker_time")
    kept = [c for c in messages.columns
            if c not in (*EVENT_SCHEMA.fieldNames(), *EVENT_COLUMNS, *helpers)]
    kind = "route" if "route" in messages.columns else "event_type"
    return messages.selectExpr(
        *kept, "event_time", "user_id", f"{kind} AS event_type",
        "device_info.device_id",
        "coalesce(device_info.device_type, device_type) AS device_type",
        "device_info.os_type", "device_info.ip_address",
        "location.city", "location.latitude", "location.longitude", "location.country",
        "authentication_method", "success", "failure_reason",
        "coalesce(activity_type, suspicious_activity.type) AS activity_type",
        "coalesce(risk_level, suspicious_activity.risk_level) AS risk_level",
        "username", "account_type")


def valid_events(messages: DataFrame, value: str = "value",
                 default: Column | None = None) -> DataFrame:
    """Canonical events of every valid message of a known kind."""
    rows = checked(messages, value, default)
    return flatten(rows.filter(F.col("error_type").isNull() & (F.col("route") != UNKNOWN)))


def dead_letters(messages: DataFrame, value: str = "value") -> DataFrame:
    """Rejected messages with the reason; messages of no known kind are not
    rejected, they are dropped."""
    rows = checked(messages, value)
    kept = [c for c in messages.columns
            if c not in EVENT_SCHEMA.fieldNames() and c != value]
    return (rows.filter(F.col("error_type").isNotNull())
            .select(*kept, "error_type", "details",
                    F.col(value).cast("string").alias("event_data"),
                    "location", F.col("event_time").alias("timestamp")))


def is_storable() -> Column:
    """Whether a flat event that never was a message has the fields the store asks for.

    Only for such events: messages are judged once, by ``with_validity``, while
    they are still nested, and stored rows are not judged again.
    """
    return F.expr(f"""
        user_id IS NOT NULL AND CASE event_type
              WHEN '{LOGIN}' THEN authentication_method IS NOT NULL AND success IS NOT NULL
              WHEN '{LOGOUT}' THEN true
              WHEN '{SUSPICIOUS}' THEN activity_type IS NOT NULL AND risk_level IS NOT NULL
              WHEN '{REGISTRATION}' THEN username IS NOT NULL AND account_type IS NOT NULL
                                         AND device_id IS NOT NULL
              ELSE false END""")


def storable(events: DataFrame) -> DataFrame:
    return events.filter(is_storable())


def fill_defaults(events: DataFrame) -> DataFrame:
    """Defaults for optional fields of a login or logout."""
    return events.withColumns({
        "city": or_unknown("city"),
        "latitude": F.coalesce("latitude", F.lit(0.0)),
        "longitude": F.coalesce("longitude", F.lit(0.0)),
        "device_type": or_unknown("device_type"),
        "os_type": or_unknown("os_type"),
        "success": F.coalesce("success", F.lit(False)),
    })


# ---- message constructors ---------------------------------------------------

def _device(*extra: str) -> Column:
    return F.struct("device_id", "device_type", "os_type", *extra)


def login_messages(events: DataFrame, *carry: str) -> DataFrame:
    return events.filter(F.col("event_type") == LOGIN).select(
        *carry, "event_type", "user_id", _device().alias("device_info"),
        "authentication_method", "success", "failure_reason",
        iso_text(F.col("event_time")).alias("timestamp"))


def logout_messages(events: DataFrame, *carry: str) -> DataFrame:
    return events.filter(F.col("event_type") == LOGOUT).select(
        *carry, "event_type", "user_id", _device().alias("device_info"),
        iso_text(F.col("event_time")).alias("timestamp"))


def suspicious_messages(events: DataFrame, *carry: str) -> DataFrame:
    return events.filter(F.col("event_type") == SUSPICIOUS).select(
        *carry, "event_type", "user_id", _device().alias("device_info"),
        "activity_type", "risk_level",
        iso_text(F.col("event_time")).alias("timestamp"))


def event_messages(events: DataFrame, *carry: str) -> DataFrame:
    """Login, logout and suspicious messages of one pass over the events.

    Fields that a kind does not have are NULL, so ``encode`` leaves them out and the
    text is that of the constructors above.
    """
    def of(kind: str, column: str) -> Column:
        return F.when(F.col("event_type") == kind, F.col(column)).alias(column)

    return events.filter(F.col("event_type").isin(LOGIN, LOGOUT, SUSPICIOUS)).select(
        *carry, "event_type", "user_id", _device().alias("device_info"),
        *(of(LOGIN, c) for c in ("authentication_method", "success", "failure_reason")),
        *(of(SUSPICIOUS, c) for c in ("activity_type", "risk_level")),
        iso_text(F.col("event_time")).alias("timestamp"))


def encode(messages: DataFrame, *carry: str) -> DataFrame:
    """One JSON text column ``value``; absent fields are left out of the text."""
    fields = [c for c in messages.columns if c not in carry]
    return messages.select(*carry, F.to_json(F.struct(*fields)).alias("value"))
