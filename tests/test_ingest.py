"""Decoding, routing and validation on hand-made messages."""

import datetime as dt
import json

import pytest
from conftest import SMALL, rows_of
from pyspark.sql import functions as F

from gatewatch.operators import ingest
from gatewatch.plans import testbed

DEVICE = {"device_id": "device_1", "device_type": "web", "os_type": "Linux"}
LOGIN = {"event_type": "login", "user_id": "u", "device_info": DEVICE,
         "authentication_method": "2fa", "success": True,
         "timestamp": "2024-01-01T10:00:00.123456"}


def messages(spark, *values):
    rows = [(i, v if isinstance(v, str) or v is None else json.dumps(v))
            for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "event_id long, value string")


def without(message, *fields):
    return {k: v for k, v in message.items() if k not in fields}


@pytest.mark.parametrize("sent, expected", [
    ("2024-01-01T10:00:00.123456", dt.datetime(2024, 1, 1, 10, 0, 0, 123456)),
    (1704067201999, dt.datetime(2024, 1, 1, 0, 0, 1, 999000)),
    ("1704067201999", dt.datetime(2024, 1, 1, 0, 0, 1, 999000)),
    ("soon", None),
    (None, None),
    ("99999999999999999999999", None),
    (99999999999999999, None),
    (-99999999999999999, None),
    (1704067201999000, None),
    (1704067201999000000, None),
    (253402300799999, dt.datetime(9999, 12, 31, 23, 59, 59, 999000)),
    ("+294247-01-10T04:00:54", None),
])
def test_event_time_of_text_and_milliseconds(spark, sent, expected):
    df = messages(spark, {**LOGIN, "timestamp": sent})
    row = (ingest.with_event_time(ingest.decode(df))
           .select(F.col("event_time").cast("timestamp_ntz")).first())
    assert row[0] == expected


def test_rejected_and_dropped_messages(spark):
    registration = {"user_id": "u", "registration": {"plan": 1}, "username": "n",
                    "account_type": "personal", "device_info": DEVICE}
    df = messages(
        spark,
        LOGIN,                                           # 0 fine
        "not json",                                      # 1
        "[1, 2]",                                        # 2 not an object
        "",                                              # 3
        None,                                            # 4
        without(LOGIN, "user_id"),                       # 5
        without(LOGIN, "success"),                       # 6
        without(LOGIN, "authentication_method"),         # 7
        {"event_type": "logout", "user_id": "u"},        # 8 no device
        {"event_type": "suspicious_activity", "user_id": "u", "device_info": DEVICE,
         "activity_type": "x"},                          # 9 no risk level
        registration,                                    # 10 fine
        without(registration, "username"),               # 11
        without(registration, "user_id"),                # 12 unknown, dropped
        {"event_type": "transfer", "user_id": "u"},      # 13 unknown, dropped
        {**LOGIN, "registration": True},                 # 14 event type wins
        {**LOGIN, "location": {"city": "c", "latitude": "north"}},  # 15 only a field is bad
    )
    rejected = {r["event_id"]: (r["error_type"], r["details"])
                for r in ingest.dead_letters(df).collect()}
    assert rejected == {
        1: ("malformed_json", "not a JSON object"),
        2: ("malformed_json", "not a JSON object"),
        3: ("malformed_json", "not a JSON object"),
        4: ("malformed_json", "not a JSON object"),
        5: ("missing_field", "missing user_id"),
        6: ("missing_field", "missing success"),
        7: ("missing_field", "missing authentication_method"),
        8: ("missing_field", "missing device_info"),
        9: ("missing_field", "missing risk_level"),
        11: ("missing_field", "missing username"),
    }
    valid = {r["event_id"]: r["event_type"] for r in ingest.valid_events(df).collect()}
    assert valid == {0: "login", 10: "registration", 14: "login", 15: "login"}


def test_times_that_cannot_be_read_are_rejected(spark):
    sent = [99999999999999999, 1704067201999000000, "yesterday", "", None, 1704067201999]
    rows = ingest.checked(messages(spark, *({**LOGIN, "timestamp": t} for t in sent))).collect()
    got = {r["event_id"]: r["error_type"] for r in rows}
    assert got == {0: "bad_timestamp", 1: "bad_timestamp", 2: "bad_timestamp",
                   3: None, 4: None, 5: None}
    # Another fault comes first, and a message of no known kind is still dropped.
    rows = ingest.checked(messages(
        spark, {**without(LOGIN, "success"), "timestamp": "x"},
        {"event_type": "transfer", "timestamp": "x"})).collect()
    assert sorted((r["event_id"], r["error_type"]) for r in rows) == [
        (0, "missing_field"), (1, None)]


def test_device_key_alone_is_enough(spark):
    row = ingest.valid_events(messages(spark, {**LOGIN, "device_info": {}})).first()
    assert row["event_type"] == "login" and row["device_id"] is None


def test_one_pass_encodes_what_the_constructors_do(events):
    parts = [ingest.encode(make(events, "event_id"), "event_id") for make in (
        ingest.login_messages, ingest.logout_messages, ingest.suspicious_messages)]
    expected = parts[0].unionByName(parts[1]).unionByName(parts[2])
    assert rows_of(ingest.encode(ingest.event_messages(events, "event_id"), "event_id")) == (
        rows_of(expected))


def test_dead_letter_keeps_text_and_location(spark):
    bad = {**without(LOGIN, "success"), "location": {"city": "c", "latitude": 1.5}}
    row = ingest.dead_letters(messages(spark, bad)).first()
    assert json.loads(row["event_data"]) == bad
    assert row["location"]["city"] == "c" and row["location"]["latitude"] == 1.5


def test_flat_device_type_and_defaults(spark):
    df = messages(spark, {"event_type": "login", "user_id": "u", "device_type": "mobile"},
                  {"event_type": "logout", "user_id": "u"})
    flat = ingest.flatten(ingest.with_event_time(ingest.decode(df)))
    rows = ingest.fill_defaults(flat).orderBy("event_id").collect()
    assert [r["device_type"] for r in rows] == ["mobile", "unknown"]
    assert rows[0]["city"] == "unknown" and rows[0]["latitude"] == 0.0
    assert rows[0]["success"] is False and rows[1]["os_type"] == "unknown"


def test_embedded_suspicious_activity(spark):
    df = messages(spark, {**LOGIN, "suspicious_activity": {"type": "t", "risk_level": "low"}})
    row = ingest.valid_events(df).first()
    assert (row["activity_type"], row["risk_level"]) == ("t", "low")


def test_default_timestamp_only_fills_gaps(spark):
    df = messages(spark, LOGIN, without(LOGIN, "timestamp"))
    default = F.lit("2024-02-02 00:00:00").cast("timestamp")
    rows = (ingest.with_default_timestamp(ingest.decode(df), default)
            .orderBy("event_id").collect())
    assert rows[0]["timestamp"] == LOGIN["timestamp"]
    assert rows[1]["timestamp"] == "2024-02-02T00:00:00.000000"
    now = ingest.with_default_timestamp(ingest.decode(df)).orderBy("event_id").collect()
    assert now[1]["timestamp"] > "2024-02-02"


def test_encoded_messages_decode_to_the_same_events(spark, events):
    logins = events.filter("event_type = 'login'")
    texts = ingest.encode(ingest.login_messages(events, "event_id"), "event_id")
    back = ingest.flatten(ingest.with_event_time(ingest.decode(texts)))
    columns = ["event_id", "event_time", "user_id", "device_id", "device_type", "os_type",
               "authentication_method", "success", "failure_reason"]
    assert rows_of(back.select(columns)) == rows_of(logins.select(columns))


def test_valid_and_rejected_and_dropped_add_up(spark):
    raw = testbed.raw_messages(spark, SMALL)
    unknown = ingest.checked(raw).filter("error_type IS NULL AND route = 'unknown'").count()
    assert (ingest.valid_events(raw).count() + ingest.dead_letters(raw).count() + unknown
            == raw.count())


def test_parsing_only_some_fields(spark):
    raw = testbed.raw_messages(spark, SMALL)
    fields = ("event_type", "location", "success")
    narrow = ingest.decode(raw, fields=fields)
    full = ingest.decode(raw)
    assert rows_of(narrow.select("event_id", *fields)) == rows_of(full.select("event_id", *fields))
    assert narrow.filter("user_id IS NOT NULL OR device_info IS NOT NULL").count() == 0
    assert set(full.columns) - set(narrow.columns) == {"malformed"}
