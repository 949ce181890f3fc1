"""Message schema and canonical event columns."""

from __future__ import annotations

from pyspark.sql import types as T

DEVICE_INFO = T.StructType([
    T.StructField("device_id", T.StringType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("os_type", T.StringType()),
    T.StructField("ip_address", T.StringType()),
])

LOCATION = T.StructType([
    T.StructField("city", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("country", T.StringType()),
])

CORRUPT_COLUMN = "_corrupt"

# Union of the login, logout, suspicious-activity and registration messages.
# ``timestamp`` is text because producers send ISO-8601 strings and epoch-ms
# numbers; ``registration`` is text because only its presence matters.
EVENT_SCHEMA = T.StructType([
    T.StructField("event_type", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("device_info", DEVICE_INFO),
    T.StructField("device_type", T.StringType()),
    T.StructField("location", LOCATION),
    T.StructField("authentication_method", T.StringType()),
    T.StructField("success", T.BooleanType()),
    T.StructField("failure_reason", T.StringType()),
    T.StructField("suspicious_activity", T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("risk_level", T.StringType()),
    ])),
    T.StructField("activity_type", T.StringType()),
    T.StructField("risk_level", T.StringType()),
    T.StructField("session_duration", T.DoubleType()),
    T.StructField("registration", T.StringType()),
    T.StructField("username", T.StringType()),
    T.StructField("account_type", T.StringType()),
    T.StructField(CORRUPT_COLUMN, T.StringType()),
])

# Columns of the canonical flat event, as the operators expect them, beside
# ``event_id``.
FLAT_SCHEMA = T.StructType([
    T.StructField("event_time", T.TimestampType()),
    *[T.StructField(n, T.StringType()) for n in (
        "user_id", "event_type", "device_id", "device_type", "os_type", "ip_address", "city")],
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("country", T.StringType()),
    T.StructField("authentication_method", T.StringType()),
    T.StructField("success", T.BooleanType()),
    *[T.StructField(n, T.StringType()) for n in (
        "failure_reason", "activity_type", "risk_level", "username", "account_type")],
])
EVENT_COLUMNS = FLAT_SCHEMA.fieldNames()

LOGIN = "login"
LOGOUT = "logout"
SUSPICIOUS = "suspicious_activity"
REGISTRATION = "registration"
UNKNOWN = "unknown"
