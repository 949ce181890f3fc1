"""Entry points: run the streams on a Kafka topic until stopped.

    spark-submit --packages <kafka connector> -m gatewatch.run analytics ...
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from gatewatch.session import build_session
from gatewatch.sources import kafka
from gatewatch.sources.store import EventStore, with_event_id
from gatewatch.streaming import gauges, jobs
from gatewatch.streaming.ordered import tick_stream

# Seconds: an hour, four hours, half a day, a day, three days.
DURATION_BUCKETS = (3600.0, 14400.0, 43200.0, 86400.0, 259200.0)


def start_analytics(messages: DataFrame, base: str, shared: bool = True,
                    drain: bool = False, preview: bool = False) -> list[StreamingQuery]:
    """The five rate and failure tables, as one shared query or as five queries."""
    events = jobs.decoded_events(messages, jobs.RATE_FIELDS)
    if shared:
        every = None if drain else jobs.SINGLE_QUERY_TRIGGER
        return [jobs.start_shared_rate_tables(events, base, every)]
    return jobs.start_rate_tables(events, base, drain, preview)


def start_monitoring(messages: DataFrame, base: str, drain: bool = False) -> list[StreamingQuery]:
    """Event store, counters, errors and places, gauges, durations, rules, users and trends.

    One query reads and parses the messages; the others read what it has decoded.
    """
    spark = messages.sparkSession
    every = None if drain else jobs.SINGLE_QUERY_TRIGGER
    often = None if drain else jobs.METRICS_TRIGGER
    decoding = jobs.start_decoded(with_event_id(messages), base, every)
    if drain:
        decoding.awaitTermination()
    seen = jobs.decoded_stream(spark, base)
    stored = jobs.valid_rows(seen)
    ticks = tick_stream(spark, f"{base}/ticks")
    return [
        decoding,
        jobs.start_store_rows(seen, EventStore(spark, f"{base}/store"), base,
                              None if drain else jobs.STORE_TRIGGER),
        jobs.start_counters(seen, base, often),
        jobs.start_place_counts(seen, base, often),
        *gauges.start_gauges(stored, base, often),
        jobs.start_users_table(stored, base, every),
        jobs.start_errors(seen, base, often),
        gauges.start_running_sessions(stored, base, often),
        jobs.start_session_durations(stored, base, every, ticks=ticks),
        jobs.start_duration_histogram(stored, base, DURATION_BUCKETS, every, ticks=ticks),
        *[jobs.start_rule(stored, name, base, every, ticks=ticks) for name in jobs.RULES],
        jobs.start_late_rows(stored, base, every=every),
        jobs.start_activity_trend(stored, base, every=every),
    ]


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("what", choices=["analytics", "monitoring"])
    parser.add_argument("--servers", required=True)
    parser.add_argument("--topic", required=True)
    parser.add_argument("--base", required=True, help="shared folder for results")
    parser.add_argument("--offsets-per-trigger", type=int, help="no limit unless given")
    parser.add_argument("--allow-data-loss", action="store_true",
                        help="skip offsets that are gone instead of failing")
    parser.add_argument("--separate", action="store_true", help="a query for each of the tables")
    args = parser.parse_args()
    spark = build_session(f"gatewatch-{args.what}")
    messages = kafka.read_stream(spark, args.servers, args.topic,
                                 offsets_per_trigger=args.offsets_per_trigger,
                                 fail_on_data_loss=not args.allow_data_loss)
    if args.what == "analytics":
        start_analytics(messages, args.base, not args.separate, preview=True)
    else:
        start_monitoring(messages, args.base)
    jobs.await_any(spark)


if __name__ == "__main__":
    main()
