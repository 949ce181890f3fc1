"""Streams over folders of Parquet files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gatewatch.sources.folders import is_folder


def parquet_stream(spark: SparkSession, path: str, schema: T.StructType | str,
                   files_per_trigger: int = 64) -> DataFrame:
    """Stream of a Parquet folder, or of one file, with a bound per micro-batch."""
    reader = (spark.readStream.schema(schema)
              .option("maxFilesPerTrigger", files_per_trigger))
    if not is_folder(spark, path):
        path, name = path.rsplit("/", 1)
        reader = reader.option("pathGlobFilter", name)
    return reader.parquet(path)
