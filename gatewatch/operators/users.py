"""User profiles and registrations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewatch.functions import has_location, is_kind
from gatewatch.schema import LOGIN, LOGOUT, REGISTRATION


def _device() -> Column:
    return F.struct("device_id", "device_type", "os_type")


def _location() -> Column:
    return F.when(has_location(), F.struct("city", "latitude", "longitude"))


def _login_row() -> Column:
    return F.struct("event_time", "event_id", _device().alias("device"),
                    _location().alias("location"))


def _registration_row() -> Column:
    return F.struct("event_time", "event_id", "username", "account_type", "device_id",
                    _location().alias("location"))


def _failures(condition: Column | None = None) -> Column:
    is_failure = ~F.col("success") if condition is None else condition & ~F.col("success")
    return F.sum(F.when(is_failure, 1).otherwise(0))


def user_profiles(events: DataFrame) -> DataFrame:
    """Fold of each user's logins, on a batch or as a streaming aggregation.

    Device and location are those of the latest login, a missing location
    included; failures add up and are never reset.
    """
    return (events.filter(is_kind(LOGIN))
            .groupBy("user_id")
            .agg(F.max(_login_row()).alias("last"), _failures().alias("failed_attempts"))
            .select("user_id",
                    F.col("last.event_time").alias("last_login"),
                    F.col("last.device").alias("last_device"),
                    F.col("last.location").alias("last_location"),
                    "failed_attempts"))


def registered_users(events: DataFrame) -> DataFrame:
    """New-user rows; the first registration of a user counts."""
    return (events.filter(is_kind(REGISTRATION))
            .groupBy("user_id")
            .agg(F.min(_registration_row()).alias("first"))
            .select("user_id", "first.username", "first.account_type",
                    F.array("first.device_id").alias("device_ids"),
                    F.lit("active").alias("account_status"),
                    F.col("first.event_time").alias("created_at"),
                    F.lit(None).cast("timestamp").alias("last_login"),
                    F.lit(0).cast("bigint").alias("failed_attempts"),
                    F.col("first.location").alias("registered_location")))


def users_table(events: DataFrame) -> DataFrame:
    """Registrations and login folds of every user in one row.

    Both sides are aggregates of the same events by the same key, so one
    conditional aggregation replaces the full outer join: one scan, one shuffle.
    """
    login, registration = is_kind(LOGIN), is_kind(REGISTRATION)
    return (events.filter(is_kind(LOGIN, REGISTRATION))
            .groupBy("user_id")
            .agg(F.min(F.when(registration, _registration_row())).alias("first"),
                 F.max(F.when(login, _login_row())).alias("last"),
                 _failures(login).alias("failed_attempts"))
            .select("user_id", "first.username", "first.account_type",
                    F.when(F.col("first").isNotNull(), F.array("first.device_id"))
                     .alias("device_ids"),
                    F.when(F.col("first").isNotNull(), "active").alias("account_status"),
                    F.col("first.event_time").alias("created_at"),
                    F.col("first.location").alias("registered_location"),
                    F.col("last.event_time").alias("last_login"),
                    F.col("last.device").alias("last_device"),
                    F.col("last.location").alias("last_location"),
                    "failed_attempts"))


def user_facts(events: DataFrame) -> DataFrame:
    """One row per user: the latest login or logout, and whether there is an account.

    ``known`` users have a login or a registration; all from one aggregation.
    """
    login, registration = is_kind(LOGIN), is_kind(REGISTRATION)
    session = F.when(is_kind(LOGIN, LOGOUT), F.struct(
        "event_time", "event_id", "event_type", "device_type", "device_id"))
    return (events.filter(is_kind(LOGIN, LOGOUT, REGISTRATION))
            .groupBy("user_id")
            .agg(F.max(session).alias("last"),
                 F.max(F.when(registration, "active")).alias("account_status"),
                 F.max(login | registration).alias("known"))
            .select("user_id", F.col("last.event_type").alias("last_type"),
                    F.col("last.device_type").alias("device_type"),
                    F.col("last.device_id").alias("device_id"), "account_status", "known"))


def user_status(users: DataFrame) -> DataFrame:
    return (users.groupBy(F.col("account_status").alias("status"))
            .agg(F.count(F.lit(1)).alias("users")))
