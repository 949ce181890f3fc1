"""Kafka source and sink (the Kafka connector has to be on the class path)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from gatewatch.operators.ingest import encode, envelope


def source_options(servers: str, topic: str, offsets_per_trigger: int | None = None,
                   fail_on_data_loss: bool = True) -> dict[str, str]:
    """Options of the source. Lost offsets fail the query, and there is no limit per
    trigger, unless the caller says otherwise."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(offsets_per_trigger)
    return options


def read_stream(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Message envelopes from the earliest offset on.

    Offsets are kept in the checkpoint of the query that reads them.
    """
    return envelope(spark.readStream.format("kafka")
                    .options(**source_options(servers, topic, **options)).load())


def write(messages: DataFrame, servers: str, topic: str) -> None:
    """Send each row of a batch as one JSON message."""
    (encode(messages).write.format("kafka")
     .option("kafka.bootstrap.servers", servers).option("topic", topic).save())


def write_stream(messages: DataFrame, servers: str, topic: str,
                 checkpoint: str) -> StreamingQuery:
    return (encode(messages).writeStream.format("kafka")
            .option("kafka.bootstrap.servers", servers).option("topic", topic)
            .option("checkpointLocation", checkpoint).start())
