"""SQL with the expected result of each registered query.

Written from the FIXTURES.md rules and the meaning of each operator, not from
the Spark code, so that both sides are independent.
"""

from __future__ import annotations

from gatewatch.plans.catalog import (
    DEFAULT_TIME,
    HISTORY_END,
    HISTORY_START,
    HISTORY_USER,
)
from gatewatch.plans.testbed import AS_OF

LOGIN_EVENTS = """
SELECT event_id, ts AS event_time, 'user_' || CAST(user_id AS VARCHAR) AS user_id,
  CASE WHEN event_type IN ('click','view','error') THEN 'login'
       WHEN event_type = 'purchase' THEN 'logout'
       WHEN k < 50 THEN 'registration' ELSE 'suspicious_activity' END AS event_type,
  'device_' || CAST(event_id % 5 + 1 AS VARCHAR) AS device_id,
  CASE WHEN event_id % 41 = 0 THEN NULL WHEN event_id % 2 = 0 THEN 'mobile' ELSE 'web' END AS device_type,
  CASE WHEN event_id % 2 = 0 THEN CASE k % 2 WHEN 0 THEN 'iOS' ELSE 'Android' END
       ELSE CASE k % 3 WHEN 0 THEN 'Windows' WHEN 1 THEN 'macOS' ELSE 'Linux' END END AS os_type,
  CASE WHEN has_loc THEN 'city_' || CAST(k % 10 AS VARCHAR) END AS city,
  CASE WHEN has_loc THEN CAST(36 + k % 10 AS DOUBLE) END AS latitude,
  CASE WHEN has_loc THEN CAST(27 + k % 10 AS DOUBLE) END AS longitude,
  CASE WHEN is_login THEN CASE event_id % 3 WHEN 0 THEN 'password' WHEN 1 THEN 'biometric' ELSE '2fa' END END AS authentication_method,
  CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_type IN ('click','view') THEN true
       WHEN event_type = 'error' THEN false END AS success,
  CASE WHEN event_type = 'error' AND k % 20 <> 19
       THEN CASE k % 3 WHEN 0 THEN 'wrong_password' WHEN 1 THEN 'expired_session' ELSE 'suspicious_location' END END AS failure_reason,
  CASE WHEN flagged THEN CASE k % 3 WHEN 0 THEN 'multiple_failed_attempts' WHEN 1 THEN 'unusual_location' ELSE 'rapid_device_switch' END END AS activity_type,
  CASE WHEN flagged THEN CASE event_id % 3 WHEN 0 THEN 'low' WHEN 1 THEN 'medium' ELSE 'high' END END AS risk_level,
  CASE WHEN event_type = 'signup' AND k < 50 THEN 'name_user_' || CAST(user_id AS VARCHAR) END AS username,
  CASE WHEN event_type = 'signup' AND k < 50 THEN CASE k % 2 WHEN 0 THEN 'personal' ELSE 'business' END END AS account_type
FROM (SELECT *, event_type IN ('click','view','error') AS is_login,
             event_type <> 'purchase' AND event_id % 50 <> 0 AS has_loc,
             (event_type = 'signup' AND k >= 50)
               OR (event_type IN ('click','view','error') AND k % 10 = 0) AS flagged
      FROM (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events) a) b
"""

# A login without a known outcome never reaches the store.
STORED = "SELECT * FROM login_events WHERE event_type <> 'login' OR success IS NOT NULL"

# Messages by their fate: broken text, a user id that was left out, a login
# without outcome, or fine.
MESSAGES = """
SELECT * REPLACE (
    CASE WHEN no_device THEN NULL ELSE device_id END AS device_id,
    CASE WHEN no_device THEN NULL ELSE device_type END AS device_type,
    CASE WHEN no_device THEN NULL ELSE os_type END AS os_type,
    CASE WHEN event_type = 'login' AND NOT success AND failure_reason IS NULL AND event_id % 2 = 0
         THEN '' ELSE failure_reason END AS failure_reason),
  CASE WHEN bad_time OR no_time THEN NULL
       WHEN event_id % 2 = 0 THEN event_time ELSE date_trunc('millisecond', event_time) END AS sent_time,
  event_id % 113 = 0 AS broken,
  CASE WHEN event_id % 89 = 0 THEN NULL ELSE user_id END AS sent_user,
  CASE WHEN event_type = 'registration' THEN NULL ELSE event_type END AS sent_type,
  CASE WHEN event_id % 113 = 0 THEN 'unknown'
       WHEN event_type = 'registration' AND event_id % 89 = 0 THEN 'unknown'
       ELSE event_type END AS route,
  CASE WHEN event_id % 113 = 0 THEN 'malformed_json'
       WHEN event_id % 89 = 0 AND event_type = 'registration' THEN NULL
       WHEN event_id % 89 = 0 THEN 'missing_field'
       WHEN event_type = 'login' AND success IS NULL THEN 'missing_field'
       WHEN bad_time THEN 'bad_timestamp' END AS error_type
FROM (SELECT *, event_id % 127 = 0 AND event_id % 131 <> 0 AS bad_time, event_id % 131 = 0 AS no_time,
        event_type = 'logout' AND event_id % 59 = 0 AS no_device FROM login_events) t
"""

ACTIVE = """
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_time DESC, event_id DESC) AS rn
  FROM {rows}) r
WHERE rn = 1 AND event_type = 'login'
"""

DURATIONS = """
SELECT event_id, user_id, event_time, device_type,
  CASE WHEN prev_type = 'login'
       THEN CAST(epoch_us(event_time) - epoch_us(prev_time) AS DOUBLE) / 1000000.0 END AS session_duration
FROM (SELECT *, lag(event_type) OVER w AS prev_type, lag(event_time) OVER w AS prev_time
      FROM login_events
      WHERE event_type = 'logout' OR (event_type = 'login' AND success)
      WINDOW w AS (PARTITION BY user_id ORDER BY event_time, event_id)) m
WHERE event_type = 'logout'
"""


def _q(body: str, **ctes: str) -> str:
    """Prepend the event views that the body (or a later view) mentions."""
    views = {"login_events": LOGIN_EVENTS, "stored": STORED, "messages": MESSAGES, **ctes}
    needed, text = [], body
    for name in reversed(list(views)):
        if name in text:
            needed.insert(0, name)
            text += views[name]
    head = ",\n".join(f"{n} AS ({views[n]})" for n in needed)
    return f"WITH {head}\n{body}" if head else body


RATE = """count(*) AS total_attempts,
  CAST(sum(CASE WHEN success THEN 1 ELSE 0 END) AS BIGINT) AS successful_attempts,
  CAST(count(*) - sum(CASE WHEN success THEN 1 ELSE 0 END) AS BIGINT) AS failed_attempts,
  round(sum(CASE WHEN success THEN 1 ELSE 0 END) * CAST(100.0 AS DOUBLE) / count(*), 2) AS success_rate"""


def _rates(*keys: str) -> str:
    names = {"login_method": "authentication_method"}
    select = ", ".join(f"{names.get(k, k)} AS {k}" for k in keys)
    group = ", ".join(names.get(k, k) for k in keys)
    return _q(f"SELECT {select}, {RATE} FROM login_events "
              f"WHERE event_type = 'login' GROUP BY {group}")


FAILURES = _q("SELECT failure_reason AS reason, count(*) AS count FROM login_events "
              "WHERE event_type = 'login' AND NOT success GROUP BY failure_reason")

HISTORY_COLUMNS = ("event_id, event_time, user_id, event_type, device_id, device_type, city, "
                   "authentication_method, success, failure_reason")


def _history(extra: str = "") -> str:
    return _q(f"SELECT {HISTORY_COLUMNS} FROM stored WHERE event_type IN ('login','logout') "
              f"AND user_id = '{HISTORY_USER}' {extra}")


SESSION_COLUMNS = ("user_id, event_id, event_time, device_id, device_type, os_type, city, "
                   "authentication_method, success")
SESSION_ROWS = "SELECT * FROM stored WHERE event_type IN ('login','logout')"


def _active(select: str, rows: str = SESSION_ROWS) -> str:
    return _q(f"SELECT {select} FROM active",
              session_rows=rows, active=ACTIVE.format(rows="session_rows"))


SESSION_COUNTERS = _q("""SELECT count(*) FILTER (WHERE event_type = 'login') AS login_events_total,
  count(*) FILTER (WHERE event_type = 'logout') AS logout_events_total,
  count(*) FILTER (WHERE event_type = 'login')
    - count(*) FILTER (WHERE event_type = 'logout') AS active_sessions_total
FROM login_events""")

SESSIONS_BY_DEVICE = _q("""SELECT coalesce(device_type, 'unknown') AS device_type,
  CAST(sum(CASE WHEN event_type = 'login' THEN 1 ELSE -1 END) AS BIGINT) AS value
FROM login_events WHERE event_type IN ('login','logout') GROUP BY 1""")

PROFILE = """SELECT p.user_id, l.event_time AS last_login, l.device_id AS last_device_id,
  l.device_type AS last_device_type, l.os_type AS last_os_type,
  l.city AS last_city, l.latitude AS last_latitude, l.longitude AS last_longitude,
  p.failed_attempts
FROM (SELECT user_id, CAST(sum(CASE WHEN success THEN 0 ELSE 1 END) AS BIGINT) AS failed_attempts
      FROM stored WHERE event_type = 'login' GROUP BY user_id) p
JOIN (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_time DESC, event_id DESC) AS rn
      FROM stored WHERE event_type = 'login') l
  ON l.user_id = p.user_id AND l.rn = 1"""

FIRST_REGISTRATION = """SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_time, event_id) AS rn
  FROM stored WHERE event_type = 'registration') r WHERE rn = 1"""

USERS = """SELECT coalesce(r.user_id, p.user_id) AS user_id, r.username, r.account_type,
  r.device_id, CASE WHEN r.user_id IS NOT NULL THEN 'active' END AS account_status,
  r.event_time AS created_at, r.city AS registered_city, r.latitude AS registered_latitude,
  r.longitude AS registered_longitude,
  p.last_login, p.last_device_id, p.last_city, p.last_latitude, p.last_longitude,
  coalesce(p.failed_attempts, 0) AS failed_attempts
FROM first_registration r FULL OUTER JOIN profile p ON r.user_id = p.user_id"""


def _histogram(source: str, value: str, label: str, bounds: tuple[tuple[str, str], ...]) -> str:
    """One SELECT per bucket; a bucket nobody falls into still has a row."""
    parts = [f"""SELECT {label}, '{le}' AS le,
  count(*) FILTER (WHERE {value} <= {upper}) AS bucket, count(*) AS count,
  CAST(sum(CAST({value} AS DECIMAL(24,6))) AS DOUBLE) AS sum
FROM {source} WHERE {value} IS NOT NULL GROUP BY {label}""" for le, upper in bounds]
    return "\nUNION ALL\n".join(parts)


DURATION_BOUNDS = (("3600", "3600"), ("14400", "14400"), ("43200", "43200"),
                   ("86400", "86400"), ("259200", "259200"), ("+Inf", "1e300"))
VALUE_BOUNDS = (("5", "5"), ("10", "10"), ("25", "25"), ("50", "50"), ("100", "100"),
                ("250", "250"), ("+Inf", "1e300"))

ALERTS = f"""SELECT city, failure_reason AS reason, count(*) AS {{name}} FROM stored
WHERE event_type = 'login' AND NOT success
  AND event_time >= TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR
GROUP BY city, failure_reason"""

# A failure lies in the 24 windows that start at its hour or up to 23 hours before.
FAILED_WINDOWS = _q("""SELECT window_start, user_id, count(*) AS failures FROM (
  SELECT user_id, date_trunc('hour', event_time) - to_hours(unnest(range(24))) AS window_start
  FROM login_events WHERE event_type = 'login' AND NOT success) w
GROUP BY window_start, user_id HAVING count(*) >= 2""")

# JSON text, field by field, absent fields left out.
TIME_TEXT = "strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f')"
DEVICE_TEXT = """',"device_info":{"device_id":"' || device_id || '"'
  || CASE WHEN device_type IS NULL THEN '' ELSE ',"device_type":"' || device_type || '"' END
  || ',"os_type":"' || os_type || '"}'"""
ENCODED = f"""SELECT event_id, '{{"event_type":"' || event_type || '","user_id":"' || user_id || '"'
  || {DEVICE_TEXT}
  || CASE WHEN event_type <> 'login' THEN '' ELSE
       ',"authentication_method":"' || authentication_method || '"'
       || CASE WHEN success IS NULL THEN '' WHEN success THEN ',"success":true' ELSE ',"success":false' END
       || CASE WHEN failure_reason IS NULL THEN '' ELSE ',"failure_reason":"' || failure_reason || '"' END
     END
  || CASE WHEN event_type <> 'suspicious_activity' THEN '' ELSE
       ',"activity_type":"' || activity_type || '","risk_level":"' || risk_level || '"' END
  || ',"timestamp":"' || {TIME_TEXT} || '"}}' AS value
FROM login_events WHERE event_type IN ('login','logout','suspicious_activity')"""


def _label(name: str, column: str) -> str:
    return f"'{name}=' || coalesce(CAST({column} AS VARCHAR), 'null')"


def _labels(**labels: str) -> str:
    return " || ',' || ".join(_label(n, c) for n, c in sorted(labels.items()))


def _samples(metric: str, labels: str, value: str, source: str) -> str:
    return (f"SELECT '{metric}' AS metric, {labels} AS labels, "
            f"CAST({value} AS DOUBLE) AS value FROM {source}")


def _counted(metric: str, labels: str, where: str, value: str = "count(*)",
             rows: str = "login_events") -> str:
    return _samples(metric, labels, value, f"{rows} WHERE {where} GROUP BY 2")


def _event_counters() -> list[str]:
    unknown = "coalesce({}, 'unknown')".format
    status = "CASE WHEN success THEN 'success' ELSE 'failure' END"
    login, both = "event_type = 'login'", "event_type IN ('login','logout')"

    balance = "sum(CASE WHEN event_type = 'login' THEN 1 ELSE -1 END)"
    return [
        _counted("login_events_total", "''", login),
        _counted("logout_events_total", "''", "event_type = 'logout'"),
        _counted("active_sessions_total", "''", both, balance),
        _counted("active_sessions_by_device", _labels(device_type=unknown("device_type")),
                both, balance),
        _counted("login_attempts_total",
                _labels(auth_method="authentication_method", status=status), login),
        _counted("authentication_failures_total",
                _labels(auth_method="authentication_method", failure_reason="failure_reason"),
                f"{login} AND NOT coalesce(success, false) AND failure_reason <> ''"),
        _counted("device_connections_total",
                _labels(device_type=unknown("device_type"), os_type=unknown("os_type")), login),
        _counted("suspicious_activities_total",
                _labels(activity_type="activity_type", risk_level="risk_level"),
                "event_type = 'suspicious_activity'"),
        _counted("suspicious_activities_by_city",
                 _labels(activity_type="activity_type", risk_level="risk_level",
                         city=unknown("city")),
                 "event_type = 'suspicious_activity'"),
        _counted("login_locations_total", _labels(city=unknown("city"), result=status), login),
        _counted("login_locations_active",
                _labels(city=unknown("city"),
                        latitude="coalesce(CAST(latitude AS VARCHAR), '0')",
                        longitude="coalesce(CAST(longitude AS VARCHAR), '0')"),
                f"{login} AND success"),
        _counted("logouts_total",
                _labels(device_type=unknown("device_type"), city=unknown("city")),
                "event_type = 'logout'"),
    ]


def _snapshot() -> str:
    parts = [
        *_event_counters(),
        _counted("device_distribution", _labels(device_type="device_type"),
                "event_type IN ('login','logout') AND device_type IS NOT NULL", rows="stored"),
        _samples("security_alerts_current", _labels(city="city", reason="reason"), "n", "alerts"),
        _samples("active_sessions_current", _labels(device_type="device_type"), "n", "by_device"),
        _samples("unique_devices_active", _labels(device_type="device_type"), "d", "by_device"),
        _samples("concurrent_users_current", "'user_type=total'", "count(*)", "active"),
        _samples("session_duration_seconds_bucket", _labels(device_type="device_type", le="le"),
                 "bucket", "hist"),
        _samples("session_duration_seconds_count", _labels(device_type="device_type"),
                 "count", "hist WHERE le = '+Inf'"),
        _samples("session_duration_seconds_sum", _labels(device_type="device_type"),
                 "sum", "hist WHERE le = '+Inf'"),
        _samples("user_status_current", _labels(status="account_status"),
                 "count(*)", "user_rows GROUP BY 2"),
        _samples("errors_total", _labels(error_type="error_type"),
                 "count(*)", "messages WHERE error_type IS NOT NULL GROUP BY 2"),
    ]
    return _q("\nUNION ALL\n".join(parts),
              alerts=ALERTS.format(name="n"),
              session_rows=SESSION_ROWS, active=ACTIVE.format(rows="session_rows"),
              by_device=BY_DEVICE,
              durations=DURATIONS,
              hist=_histogram("durations", "session_duration", "device_type", DURATION_BOUNDS),
              first_registration=FIRST_REGISTRATION, profile=PROFILE, user_rows=USERS)


BY_DEVICE = ("SELECT device_type, count(*) AS n, count(DISTINCT device_id) AS d "
             "FROM active GROUP BY device_type")


def _gauges() -> str:
    """What the store-fed gauges show; logouts have no method and no success."""
    session = "event_type IN ('login','logout')"
    parts = [
        _counted("stored_login_attempts_current",
                 _labels(auth_method="authentication_method", status="'success'"),
                 session, "sum(CASE WHEN success THEN 1 ELSE 0 END)", "stored"),
        _counted("stored_login_attempts_current",
                 _labels(auth_method="authentication_method", status="'failure'"),
                 session, "sum(CASE WHEN success THEN 0 ELSE 1 END)", "stored"),
        _counted("device_distribution", _labels(device_type="device_type"),
                 f"{session} AND device_type IS NOT NULL", rows="stored"),
        _samples("security_alerts_current", _labels(city="city", reason="reason"), "n", "alerts"),
        _samples("active_sessions_current", _labels(device_type="device_type"), "n", "by_device"),
        _samples("unique_devices_active", _labels(device_type="device_type"), "d", "by_device"),
        _samples("concurrent_users_current", "'user_type=total'", "count(*)", "active"),
    ]
    return _q("\nUNION ALL\n".join(parts), alerts=ALERTS.format(name="n"),
              session_rows=SESSION_ROWS, active=ACTIVE.format(rows="session_rows"),
              by_device=BY_DEVICE)


def _shared_tables() -> str:
    def part(name: str, *keys: str) -> str:
        key = " || '/' || ".join(f"coalesce({k}, 'null')" for k in keys)
        return f"""SELECT '{name}' AS table_name, {key} AS group_key, count(*) AS total_attempts,
  CAST(sum(CASE WHEN success THEN 0 ELSE 1 END) AS BIGINT) AS failed_attempts
FROM login_events WHERE event_type = 'login' GROUP BY 2"""
    failures = """SELECT 'failure_metrics' AS table_name, coalesce(failure_reason, 'null') AS group_key,
  count(*) AS total_attempts, count(*) AS failed_attempts
FROM login_events WHERE event_type = 'login' AND NOT success GROUP BY 2"""
    return _q("\nUNION ALL\n".join([
        part("combo_metrics", "city", "device_type", "authentication_method"),
        part("city_metrics", "city"), part("method_metrics", "authentication_method"),
        part("device_metrics", "device_type"), failures]))


def _previous(select: str, where: str, result: str) -> str:
    return _q(f"""SELECT {result} FROM (
  SELECT *, {select} FROM login_events WHERE {where}
  WINDOW w AS (PARTITION BY user_id ORDER BY event_time, event_id)) p""")


def oracle() -> dict[str, str]:
    found = _oracle()
    # Streams whose result is that of a batch query.
    for name in ("rule_multiple_failed", "rule_unusual_location", "rule_device_switch",
                 "errors_total", "user_status"):
        found[f"stream_{name}"] = found[name]
    found["stream_triggered_counters"] = found["session_counters"]
    found["stream_progress"] = ("SELECT 'session_counters' AS query, "
                                "CAST(count(*) AS BIGINT) AS rows_read FROM events")
    found["stream_duration_histogram"] = found["session_duration_histogram"]
    found["stream_running_sessions"] = found["active_sessions_trend"]
    found["stream_late_trend"] = found["activity_trend"]
    found["stream_late_durations"] = found["session_durations"]
    # Sketches of so few devices are exact.
    found["stream_unique_devices"] = _q(
        """SELECT device_type, count(DISTINCT device_id) AS unique_devices FROM login_events
WHERE event_type IN ('login','logout') GROUP BY 1""")
    found["store_compacted"] = _q(
        """SELECT CASE WHEN error_type IS NOT NULL THEN 'system_errors'
  WHEN route IN ('login','logout') THEN 'login_events'
  WHEN route = 'suspicious_activity' THEN 'security_events' ELSE 'registrations' END AS table_name,
  count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids, count(DISTINCT event_id) AS distinct_ids
FROM messages WHERE error_type IS NOT NULL OR route <> 'unknown' GROUP BY 1""")
    return found


def _oracle() -> dict[str, str]:
    combo = _rates("city", "device_type", "login_method")
    city, method, device = _rates("city"), _rates("login_method"), _rates("device_type")
    trend = _q("SELECT date_trunc('hour', event_time) AS window_start, event_type, "
               "count(*) AS events FROM login_events GROUP BY 1, 2")
    profiles = _q("SELECT * FROM profile", profile=PROFILE)
    durations = _q("SELECT * FROM durations", durations=DURATIONS)
    users_rows = _q("SELECT * FROM user_rows", first_registration=FIRST_REGISTRATION,
                    profile=PROFILE, user_rows=USERS)
    return {
        "decode_json": "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k "
                       "FROM events",
        "kafka_envelope": _q(
            """SELECT 'login-events' AS topic, CAST(event_id % 4 AS INTEGER) AS partition,
  CAST(event_id // 4 AS BIGINT) AS "offset",
  TIMESTAMP '2024-01-01 00:00:00' + to_microseconds(event_id * 250000) AS timestamp,
  value FROM raw_text""", raw_text=_raw_text()),
        "event_time_derive": _q(
            "SELECT event_id, CASE WHEN NOT broken THEN sent_time END AS event_time, "
            "broken AS malformed FROM messages"),
        "default_timestamp": _q(
            f"SELECT event_id, CASE WHEN broken OR no_time THEN TIMESTAMP '{DEFAULT_TIME}' "
            "ELSE sent_time END AS event_time FROM messages"),
        "encode_json": _q(ENCODED),
        "flatten_event": _q(
            """SELECT event_id,
  CASE WHEN NOT broken THEN sent_type END AS event_type,
  CASE WHEN NOT broken THEN sent_user END AS user_id,
  CASE WHEN NOT broken THEN device_id END AS device_id,
  CASE WHEN NOT broken THEN device_type END AS device_type,
  CASE WHEN NOT broken THEN os_type END AS os_type,
  CASE WHEN NOT broken THEN city END AS city,
  CASE WHEN NOT broken THEN latitude END AS latitude,
  CASE WHEN NOT broken THEN longitude END AS longitude,
  CASE WHEN NOT broken THEN authentication_method END AS login_method,
  CASE WHEN NOT broken AND event_type = 'login' THEN success END AS success,
  CASE WHEN NOT broken THEN failure_reason END AS failure_reason
FROM messages"""),
        "route_events": _q("SELECT event_id, route FROM messages"),
        "valid_events": _q(
            """SELECT event_id, sent_time AS event_time, sent_user AS user_id, event_type,
  device_id, device_type, os_type, city, latitude, longitude, authentication_method,
  CASE WHEN event_type = 'login' THEN success END AS success, failure_reason, activity_type,
  risk_level, username, account_type
FROM messages WHERE error_type IS NULL AND route <> 'unknown'"""),
        "dead_letters": _q(
            """SELECT event_id, error_type,
  CASE WHEN broken THEN 'not a JSON object'
       WHEN error_type = 'bad_timestamp' THEN 'unreadable timestamp'
       WHEN sent_user IS NULL THEN 'missing user_id' ELSE 'missing success' END AS details,
  CASE WHEN NOT broken THEN city END AS city,
  CASE WHEN NOT broken THEN latitude END AS latitude,
  CASE WHEN NOT broken THEN longitude END AS longitude,
  CASE WHEN NOT broken THEN sent_time END AS timestamp
FROM messages WHERE error_type IS NOT NULL"""),
        "filter_logins": _q(
            "SELECT event_id, event_time, user_id, authentication_method, success "
            "FROM login_events WHERE event_type = 'login'"),
        "filter_failed_logins": _q(
            "SELECT event_id, event_time, user_id, failure_reason FROM login_events "
            "WHERE event_type = 'login' AND NOT success"),
        "fill_defaults": _q(
            """SELECT event_id, coalesce(city, 'unknown') AS city, coalesce(latitude, 0.0) AS latitude,
  coalesce(longitude, 0.0) AS longitude, coalesce(device_type, 'unknown') AS device_type,
  coalesce(os_type, 'unknown') AS os_type, coalesce(success, false) AS success
FROM login_events WHERE event_type IN ('login','logout')"""),
        "topn_preview": f"{combo} ORDER BY 1 NULLS FIRST, 2 NULLS FIRST, 3 NULLS FIRST LIMIT 50",
        "combo_metrics": combo,
        "city_metrics": city,
        "method_metrics": method,
        "device_metrics": device,
        "failure_metrics": FAILURES,
        "login_rate_grouping_sets": _q(
            f"""SELECT city, device_type, authentication_method AS login_method,
  CAST(GROUPING(city, device_type, authentication_method) AS BIGINT) AS grouping_id, {RATE}
FROM login_events WHERE event_type = 'login'
GROUP BY GROUPING SETS ((city, device_type, authentication_method), (city),
                        (authentication_method), (device_type))"""),
        "store_attempts_by_method": _q(
            """SELECT authentication_method, count(*) AS total_attempts,
  CAST(sum(CASE WHEN success THEN 1 ELSE 0 END) AS BIGINT) AS successful_attempts,
  CAST(count(*) - sum(CASE WHEN success THEN 1 ELSE 0 END) AS BIGINT) AS failed_attempts
FROM stored WHERE event_type IN ('login','logout') GROUP BY authentication_method"""),
        "device_distribution": _q(
            "SELECT device_type, count(*) AS count FROM stored "
            "WHERE event_type IN ('login','logout') GROUP BY device_type"),
        "location_distribution": _q(
            "SELECT city, count(*) AS count FROM stored "
            "WHERE event_type IN ('login','logout') AND city IS NOT NULL GROUP BY city"),
        "security_failures_24h": _q(ALERTS.format(name="count")),
        "login_history": _history(),
        "login_history_from": _history(f"AND event_time >= TIMESTAMP '{HISTORY_START}'"),
        "login_history_until": _history(f"AND event_time <= TIMESTAMP '{HISTORY_END}'"),
        "login_history_between": _history(
            f"AND event_time BETWEEN TIMESTAMP '{HISTORY_START}' AND TIMESTAMP '{HISTORY_END}'"),
        "active_sessions": _active(SESSION_COLUMNS),
        "active_sessions_successful": _active(
            SESSION_COLUMNS,
            "SELECT * FROM stored WHERE event_type = 'logout' OR (event_type = 'login' AND success)"),
        "session_counters": SESSION_COUNTERS,
        "active_sessions_by_device": SESSIONS_BY_DEVICE,
        "login_attempts_total": _q(
            """SELECT authentication_method AS auth_method,
  CASE WHEN success THEN 'success' ELSE 'failure' END AS status, count(*) AS value
FROM login_events WHERE event_type = 'login' GROUP BY 1, 2"""),
        "store_login_attempts_total": _q(
            """SELECT authentication_method AS auth_method, 'success' AS status,
  CAST(sum(CASE WHEN success THEN 1 ELSE 0 END) AS BIGINT) AS value
FROM stored WHERE event_type IN ('login','logout') GROUP BY 1
UNION ALL
SELECT authentication_method, 'failure',
  CAST(sum(CASE WHEN success THEN 0 ELSE 1 END) AS BIGINT)
FROM stored WHERE event_type IN ('login','logout') GROUP BY 1"""),
        "auth_failures_total": _q(
            """SELECT authentication_method AS auth_method, failure_reason, count(*) AS value
FROM login_events WHERE event_type = 'login' AND NOT coalesce(success, false)
  AND failure_reason <> '' GROUP BY 1, 2"""),
        "device_connections_total": _q(
            """SELECT coalesce(device_type, 'unknown') AS device_type,
  coalesce(os_type, 'unknown') AS os_type, count(*) AS value
FROM login_events WHERE event_type = 'login' GROUP BY 1, 2"""),
        "suspicious_activities_total": _q(
            """SELECT activity_type, risk_level, count(*) AS value FROM login_events
WHERE event_type = 'suspicious_activity' GROUP BY 1, 2"""),
        "suspicious_activities_by_city": _q(
            """SELECT activity_type, risk_level, coalesce(city, 'unknown') AS city,
  count(*) AS value
FROM login_events WHERE event_type = 'suspicious_activity' GROUP BY 1, 2, 3"""),
        "login_locations_total": _q(
            """SELECT coalesce(city, 'unknown') AS city,
  CASE WHEN success THEN 'success' ELSE 'failure' END AS result, count(*) AS value
FROM login_events WHERE event_type = 'login' GROUP BY 1, 2"""),
        "login_locations_active": _q(
            """SELECT coalesce(city, 'unknown') AS city,
  coalesce(CAST(latitude AS VARCHAR), '0') AS latitude,
  coalesce(CAST(longitude AS VARCHAR), '0') AS longitude, count(*) AS value
FROM login_events WHERE event_type = 'login' AND success GROUP BY 1, 2, 3"""),
        "logouts_by_device_city": _q(
            """SELECT coalesce(device_type, 'unknown') AS device_type,
  coalesce(city, 'unknown') AS city, count(*) AS value
FROM login_events WHERE event_type = 'logout' GROUP BY 1, 2"""),
        "security_alerts_current": _q(ALERTS.format(name="value")),
        "device_gauge": _q(
            """SELECT device_type, count(*) AS value FROM stored
WHERE event_type IN ('login','logout') AND device_type IS NOT NULL GROUP BY device_type"""),
        "concurrent_users": _active("'total' AS user_type, count(*) AS value"),
        "active_sessions_current": _active("device_type, count(*) AS value")
                                   + " GROUP BY device_type",
        "unique_devices_active": _active("device_type, count(DISTINCT device_id) AS value")
                                 + " GROUP BY device_type",
        "session_duration_histogram": _q(
            _histogram("durations", "session_duration", "device_type", DURATION_BOUNDS),
            durations=DURATIONS),
        "value_histogram": _histogram("events", "value", "event_type", VALUE_BOUNDS),
        "value_summary": """SELECT event_type, count(value) AS count,
  CAST(sum(CAST(value AS DECIMAL(24,6))) AS DOUBLE) AS sum FROM events GROUP BY event_type""",
        "errors_total": _q("SELECT error_type, count(*) AS value FROM messages "
                           "WHERE error_type IS NOT NULL GROUP BY error_type"),
        "metrics_snapshot": _snapshot(),
        "user_profiles": profiles,
        "registered_users": _q(
            """SELECT user_id, username, account_type, device_id, CAST(1 AS BIGINT) AS devices,
  'active' AS account_status, event_time AS created_at, CAST(NULL AS TIMESTAMP) AS last_login,
  CAST(0 AS BIGINT) AS failed_attempts, city AS registered_city,
  latitude AS registered_latitude, longitude AS registered_longitude
FROM first_registration""", first_registration=FIRST_REGISTRATION),
        "users_table": users_rows,
        "user_status": _q("SELECT account_status AS status, count(*) AS users FROM user_rows "
                          "GROUP BY account_status", first_registration=FIRST_REGISTRATION,
                          profile=PROFILE, user_rows=USERS),
        "session_durations": durations,
        "session_durations_in_slots": durations,
        "activity_trend": trend,
        "active_sessions_trend": _q(
            """SELECT window_start, net_change,
  CAST(sum(net_change) OVER (ORDER BY window_start ROWS UNBOUNDED PRECEDING) AS BIGINT) AS active_sessions
FROM (SELECT date_trunc('hour', event_time) AS window_start,
        CAST(sum(CASE WHEN event_type = 'login' THEN 1 ELSE -1 END) AS BIGINT) AS net_change
      FROM login_events WHERE event_type IN ('login','logout') GROUP BY 1) h"""),
        "rule_multiple_failed": _q(
            """SELECT event_id, user_id, event_time FROM (
  SELECT *, count(*) OVER (PARTITION BY user_id ORDER BY event_time
    RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND CURRENT ROW) AS failures
  FROM login_events WHERE event_type = 'login' AND NOT success) f
WHERE failures >= 2"""),
        "rule_failed_windows": FAILED_WINDOWS,
        "rule_unusual_location": _previous(
            "lag(city) OVER w AS previous_city", "event_type = 'login' AND city IS NOT NULL",
            "event_id, user_id, event_time, city, previous_city")
            + " WHERE city <> previous_city",
        "rule_device_switch": _previous(
            "lag(device_id) OVER w AS previous_device, lag(event_time) OVER w AS previous_time",
            "event_type = 'login'",
            "event_id, user_id, event_time, device_id, previous_device, "
            "CAST(epoch_us(event_time) - epoch_us(previous_time) AS DOUBLE) / 1000000.0 "
            "AS seconds_since")
            + " WHERE device_id <> previous_device "
              "AND epoch_us(event_time) - epoch_us(previous_time) <= 21600000000",
        "suspicious_events": _q(
            """SELECT event_id, event_time, user_id, device_id, city, activity_type, risk_level,
  CASE WHEN event_type = 'login' THEN 'login' ELSE 'standalone' END AS origin
FROM login_events WHERE event_type IN ('login','suspicious_activity')
  AND activity_type IS NOT NULL"""),
        "stream_combo_metrics": combo,
        "stream_city_metrics": city,
        "stream_failure_metrics": FAILURES,
        "stream_method_metrics": method,
        "stream_device_metrics": device,
        "stream_shared_rate_tables": _shared_tables(),
        "stream_session_counters": SESSION_COUNTERS,
        "stream_active_sessions_by_device": SESSIONS_BY_DEVICE,
        "stream_counters": _q("\nUNION ALL\n".join(_event_counters())),
        "stream_active_sessions": _active(SESSION_COLUMNS),
        "stream_failed_windows": FAILED_WINDOWS,
        "stream_activity_trend": trend,
        "stream_user_profile": profiles,
        "stream_users_table": users_rows,
        "stream_gauges": _gauges(),
        "stream_session_durations": _q("SELECT *, false AS late FROM durations",
                                       durations=DURATIONS),
    }


def _raw_text() -> str:
    """The nested message text of FIXTURES.md section 4."""
    def text(name: str, column: str) -> str:
        return (f"CASE WHEN {column} IS NULL THEN '' "
                f"ELSE ',\"{name}\":\"' || {column} || '\"' END")
    fields = " || ".join([
        "CASE WHEN sent_type IS NULL THEN '' ELSE '\"event_type\":\"' || sent_type || '\",' END",
        "CASE WHEN sent_user IS NULL THEN '' ELSE '\"user_id\":\"' || sent_user || '\",' END",
        "'\"device_info\":{'",
        "CASE WHEN no_device THEN '' ELSE '\"device_id\":\"' || device_id || '\"' END",
        text("device_type", "device_type"),
        text("os_type", "os_type"),
        "CASE WHEN event_type = 'login' THEN ',\"ip_address\":\"192.0.2.' "
        "|| CAST(event_id % 255 + 1 AS VARCHAR) || '\"' ELSE '' END",
        "'}'",
        "CASE WHEN city IS NULL THEN '' ELSE ',\"location\":{\"city\":\"' || city "
        "|| '\",\"latitude\":' || CAST(latitude AS VARCHAR) || ',\"longitude\":' "
        "|| CAST(longitude AS VARCHAR) || ',\"country\":\"Country\"}' END",
        text("authentication_method", "authentication_method"),
        "CASE WHEN event_type <> 'login' OR success IS NULL THEN '' "
        "WHEN success THEN ',\"success\":true' ELSE ',\"success\":false' END",
        text("failure_reason", "failure_reason"),
        "CASE WHEN event_type = 'login' AND activity_type IS NOT NULL THEN "
        "',\"suspicious_activity\":{\"type\":\"' || activity_type || '\",\"risk_level\":\"' "
        "|| risk_level || '\"}' ELSE '' END",
        "CASE WHEN event_type <> 'login' AND activity_type IS NOT NULL THEN "
        "',\"activity_type\":\"' || activity_type || '\",\"risk_level\":\"' "
        "|| risk_level || '\"' ELSE '' END",
        "CASE WHEN event_type = 'registration' THEN ',\"registration\":true' ELSE '' END",
        text("username", "username"),
        text("account_type", "account_type"),
        "CASE WHEN no_time THEN '' ELSE ',\"timestamp\":' || CASE "
        "WHEN bad_time AND event_id % 2 = 0 THEN '\"yesterday\"' "
        "WHEN event_id % 2 = 0 THEN '\"' || " + TIME_TEXT + " || '\"' "
        "WHEN event_id % 381 = 0 THEN CAST(epoch_us(event_time) * 1000 AS VARCHAR) "
        "WHEN bad_time THEN '99999999999999999' "
        "ELSE CAST(epoch_us(event_time) // 1000 AS VARCHAR) END END",
    ])
    return (f"SELECT event_id, CASE WHEN broken THEN 'not json' ELSE '{{' || {fields} || '}}' END "
            "AS value FROM messages")
