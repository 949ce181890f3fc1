"""Login events and raw messages derived from the given ``events`` table.

The mapping follows FIXTURES.md. It is a projection only: one output row per
row of ``events`` and no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatewatch.sources.folders import file_names, order_files, shared_folder

AS_OF = "2024-01-31 00:00:00"
DURATION_BUCKETS = (3600.0, 14400.0, 43200.0, 86400.0, 259200.0)


# Stated, so that building a query starts no job that looks into the files.
EVENTS_SCHEMA = ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
                 "value double, props string")


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def to_login_events(events: DataFrame, k_once: bool = True) -> DataFrame:
    """FIXTURES.md section 3, for batch or streaming ``events``.

    k goes through ``inline``, so that it is taken out of the JSON once and not again in
    each column that looks at it. Without ``k_once`` it is a plain expression, which
    vanishes, with the JSON column, where no column looks at it.
    """
    k = "CAST(get_json_object(props, '$.k') AS INT)"
    keyed = events.selectExpr(
        "event_id",
        "CAST(ts AS TIMESTAMP) AS event_time",
        "concat('user_', user_id) AS user_id",
        "event_type AS src",
        f"inline(array(named_struct('k', {k})))" if k_once else f"{k} AS k")
    is_login = "src IN ('click', 'view', 'error')"
    has_loc = "src <> 'purchase' AND event_id % 50 <> 0"
    flagged = f"(src = 'signup' AND k >= 50) OR ({is_login} AND k % 10 = 0)"
    registers = "src = 'signup' AND k < 50"
    return keyed.selectExpr(
        "event_id", "event_time", "user_id",
        # Nested so that a filter on one kind folds to a test of the source
        # column alone, and the JSON column is not read for it.
        f"""CASE WHEN {is_login} THEN 'login' ELSE
              CASE WHEN src = 'purchase' THEN 'logout' ELSE
                CASE WHEN k < 50 THEN 'registration' ELSE 'suspicious_activity' END
              END
            END AS event_type""",
        "concat('device_', event_id % 5 + 1) AS device_id",
        """CASE WHEN event_id % 41 = 0 THEN NULL
                WHEN event_id % 2 = 0 THEN 'mobile' ELSE 'web' END AS device_type""",
        """CASE WHEN event_id % 2 = 0 THEN CASE k % 2 WHEN 0 THEN 'iOS' ELSE 'Android' END
                ELSE CASE k % 3 WHEN 0 THEN 'Windows' WHEN 1 THEN 'macOS' ELSE 'Linux' END
           END AS os_type""",
        f"CASE WHEN {has_loc} THEN concat('city_', k % 10) END AS city",
        f"CASE WHEN {has_loc} THEN CAST(36 + k % 10 AS DOUBLE) END AS latitude",
        f"CASE WHEN {has_loc} THEN CAST(27 + k % 10 AS DOUBLE) END AS longitude",
        f"""CASE WHEN {is_login} THEN CASE event_id % 3
              WHEN 0 THEN 'password' WHEN 1 THEN 'biometric' ELSE '2fa' END
            END AS authentication_method""",
        """CASE WHEN event_id % 97 = 0 THEN NULL WHEN src IN ('click', 'view') THEN true
                WHEN src = 'error' THEN false END AS success""",
        """CASE WHEN src = 'error' AND k % 20 <> 19 THEN CASE k % 3
             WHEN 0 THEN 'wrong_password' WHEN 1 THEN 'expired_session'
             ELSE 'suspicious_location' END END AS failure_reason""",
        f"""CASE WHEN {flagged} THEN CASE k % 3
              WHEN 0 THEN 'multiple_failed_attempts' WHEN 1 THEN 'unusual_location'
              ELSE 'rapid_device_switch' END END AS activity_type""",
        f"""CASE WHEN {flagged} THEN CASE event_id % 3
              WHEN 0 THEN 'low' WHEN 1 THEN 'medium' ELSE 'high' END END AS risk_level""",
        f"CASE WHEN {registers} THEN concat('name_', user_id) END AS username",
        f"""CASE WHEN {registers} THEN CASE k % 2
              WHEN 0 THEN 'personal' ELSE 'business' END END AS account_type""")


# Source event types of each kind of message.
SOURCE_TYPES = {
    "login": ("click", "view", "error"),
    "logout": ("purchase",),
    "registration": ("signup",),
    "suspicious_activity": ("signup",),
}


# Least number of slices, and rows of a file: what a task is worth, and what it takes at most.
SLICES = 6
LEAST_ROWS, MOST_ROWS = 20_000, 250_000
_slices: dict[tuple[str, str, bool], tuple[str, int]] = {}


def slice_sizes(rows: int, cores: int) -> tuple[int, int]:
    """Slices of a table, and files of a slice, so that each core has one where that pays.

    A file has at most ``MOST_ROWS`` rows, more or less, so a larger table has more slices.
    """
    files = max(1, min(cores, rows // (SLICES * LEAST_ROWS)))
    return max(SLICES, -(-rows // (files * MOST_ROWS))), files


def event_slices(spark: SparkSession, sf_dir: str, mixed: bool = False) -> tuple[str, int]:
    """A shared folder with the whole ``events`` table as slices that follow in time, and
    the number of files of a slice.

    Streams that take one slice per trigger see several micro-batches. A task reads a file, as
    Parquet files of this size have one row group, so slices of large tables have one for
    each core. The files are written once per session by one job, range by range. A stream
    takes files by their modification time, which is set to the order of the ranges; with
    ``mixed``, to every second slice before the others.
    """
    key = (spark.sparkContext.applicationId, sf_dir, mixed)
    if key not in _slices:
        folder = shared_folder(spark)
        events = raw_events(spark, sf_dir)
        slices, files = slice_sizes(events.count(), spark.sparkContext.defaultParallelism)
        (events.repartitionByRange(slices * files, "ts").sortWithinPartitions("ts")
         .write.mode("append").parquet(folder))
        names = file_names(spark, folder, ".parquet")
        parts = [names[k:k + files] for k in range(0, len(names), files)]
        order_files(spark, folder, sum(parts[1::2] + parts[::2] if mixed else parts, []))
        _slices[key] = folder, files
    return _slices[key]


def login_events(spark: SparkSession, sf_dir: str, *kinds: str,
                 k_once: bool = True) -> DataFrame:
    """Mapped events; ``kinds`` names what the caller looks at, if not all.

    The kind is computed here, so Catalyst cannot turn a filter on it into one
    that Parquet understands; naming the kinds filters the source column.
    """
    events = raw_events(spark, sf_dir)
    if kinds:
        types = sorted({t for kind in kinds for t in SOURCE_TYPES[kind]})
        events = events.filter(events["event_type"].isin(types))
    return to_login_events(events, k_once)


def to_raw_messages(events: DataFrame) -> DataFrame:
    """FIXTURES.md section 4: one JSON text per event, some of them broken."""
    login, registration = "event_type = 'login'", "event_type = 'registration'"
    device = """named_struct(
                 'device_id', device_id, 'device_type', device_type, 'os_type', os_type,
                 'ip_address', if(event_type = 'login',
                                  concat('192.0.2.', event_id % 255 + 1), NULL))"""
    texts = events.selectExpr(
        "event_id",
        """CAST(CASE WHEN event_id % 381 = 0 THEN unix_micros(event_time) * 1000
                     WHEN event_id % 127 = 0 THEN 99999999999999999
                     ELSE unix_millis(event_time) END AS STRING) AS millis""",
        f"""to_json(named_struct(
              'event_type', if({registration}, NULL, event_type),
              'user_id', if(event_id % 89 = 0, NULL, user_id),
              'device_info', if(event_type = 'logout' AND event_id % 59 = 0,
                 from_json('{{}}', 'device_id string, device_type string, os_type string, '
                                   || 'ip_address string'), {device}),
              'location', if(city IS NULL, NULL, named_struct(
                 'city', city, 'latitude', latitude, 'longitude', longitude,
                 'country', 'Country')),
              'authentication_method', authentication_method,
              'success', if({login}, success, NULL),
              'failure_reason', if({login} AND NOT success AND failure_reason IS NULL
                 AND event_id % 2 = 0, '', failure_reason),
              'suspicious_activity', if({login} AND activity_type IS NOT NULL,
                 named_struct('type', activity_type, 'risk_level', risk_level), NULL),
              'activity_type', if({login}, NULL, activity_type),
              'risk_level', if({login}, NULL, risk_level),
              'registration', if({registration}, true, NULL),
              'username', username,
              'account_type', account_type,
              'timestamp', CASE WHEN event_id % 2 = 1 OR event_id % 131 = 0 THEN NULL
                 WHEN event_id % 127 = 0 THEN 'yesterday'
                 ELSE date_format(event_time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS") END)) AS text""")
    # Odd rows carry the time as a JSON number instead of text.
    return texts.selectExpr(
        "event_id",
        """CASE WHEN event_id % 113 = 0 THEN 'not json'
                WHEN event_id % 2 = 0 OR event_id % 131 = 0 THEN text
                ELSE concat(substring(text, 1, length(text) - 1), ',"timestamp":', millis, '}')
           END AS value""")


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_raw_messages(login_events(spark, sf_dir))


def kafka_rows(messages: DataFrame, topic: str = "login-events") -> DataFrame:
    """The same messages in the column layout of a Kafka source."""
    return messages.selectExpr(
        "event_id",
        f"'{topic}' AS topic",
        "CAST(event_id % 4 AS INT) AS partition",
        "event_id DIV 4 AS offset",
        "timestamp_millis(1704067200000 + event_id * 250) AS timestamp",
        "CAST(value AS BINARY) AS value")
