"""foreachBatch sinks that can be repeated without changing their result."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gatewatch.operators.store_queries import top_rows
from gatewatch.sources.folders import (
    complete_versions,
    read_texts,
    remove_folder,
    remove_version,
    sub_folders,
    write_text,
)

Sink = Callable[[DataFrame, int], None]
# Hash buckets of folders that were begun before the number was noted in them.
UNNOTED_BUCKETS = 64


def snapshot_sink(folder: str, order: Sequence[str] = (), preview: int = 0,
                  keep: int = 3) -> Sink:
    """Replace the whole result table by each micro-batch.

    A version is written beside the older ones and counts once it is committed,
    so readers see either the old or the new table, also an empty one. The last
    ``keep`` versions stay for readers that have already begun. A repeated epoch
    leaves its committed version as it is.
    """
    def write(df: DataFrame, epoch: int) -> None:
        spark = df.sparkSession
        if epoch in complete_versions(spark, folder, "epoch"):
            return
        df.write.mode("overwrite").parquet(f"{folder}/epoch={epoch}")
        if preview:
            top_rows(read_snapshot(spark, folder), order, preview).show(preview, truncate=False)
        for old in complete_versions(spark, folder, "epoch")[:-keep]:
            remove_version(spark, folder, "epoch", old)
    return write


def read_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    versions = complete_versions(spark, folder, "epoch")
    if not versions:
        raise FileNotFoundError(f"no committed version in {folder}")
    return spark.read.parquet(f"{folder}/epoch={versions[-1]}")


def bucket_count(spark: SparkSession, folder: str) -> int:
    """Hash buckets of a folder: as many as the cluster has cores when it is begun.

    The number is noted in the folder, so that a later session finds its keys again.
    """
    for text in read_texts(spark, f"{folder}/_buckets").values():
        if text:
            return int(text)
    begun = any(complete_versions(spark, folder, kind) for kind in ("epoch", "base"))
    number = UNNOTED_BUCKETS if begun else max(1, spark.sparkContext.defaultParallelism)
    write_text(spark, f"{folder}/_buckets", str(number))
    return number


def hash_bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("string")


def date_bucket(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd")


def changes_sink(folder: str, keys: Sequence[str], merge_every: int = 50,
                 bucket: Column | None = None) -> Sink:
    """Keep the changed rows of each micro-batch of an update-mode query.

    The running values live in Spark's state store; a repeated epoch that was
    committed changes nothing. From time to time the newest row per key becomes a new
    base, which bounds what a reader has to merge. Base and changes are split by
    ``bucket``, a text made of the keys (by default a hash), and only the buckets
    that changed since the last base are merged and written again. With the
    date as bucket, closed dates are never touched. Rows are gathered by bucket where there
    are few of them and dealt to several tasks where there are many.
    """
    def write(df: DataFrame, epoch: int) -> None:
        spark = df.sparkSession
        if epoch not in complete_versions(spark, folder, "epoch"):
            of = hash_bucket(keys, bucket_count(spark, folder)) if bucket is None else bucket
            _write_buckets(df.withColumn("bucket", of), f"{folder}/epoch={epoch}")
        if epoch and epoch % merge_every == 0:
            merge_changes(spark, folder, keys, epoch)
    return write


def _write_buckets(rows: DataFrame, folder: str) -> None:
    # The rebalance lets Spark size the tasks: small buckets share one, large ones are split.
    (rows.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket")
     .parquet(folder))


def merge_changes(spark: SparkSession, folder: str, keys: Sequence[str], epoch: int) -> None:
    """Write a new base for the buckets that changed since the last one."""
    bases = complete_versions(spark, folder, "base")
    if epoch not in bases:
        after = [e for e in complete_versions(spark, folder, "epoch")
                 if e <= epoch and (not bases or e > bases[-1])]
        touched = {b for e in after for b in _buckets(spark, f"{folder}/epoch={e}")}
        rows = _newest_rows(spark, folder, keys, bases, after, touched)
        if rows is not None:
            _write_buckets(rows, f"{folder}/base={epoch}")
    # What the base before this one covers is no longer read by anyone.
    covered = bases[-2:-1] if epoch in bases else bases[-1:]
    for old in complete_versions(spark, folder, "epoch"):
        if covered and old <= covered[0]:
            remove_version(spark, folder, "epoch", old)
    live = _live_buckets(spark, folder, covered[0]) if covered else {}
    for base in bases:
        if covered and base < covered[0]:
            for b in _buckets(spark, f"{folder}/base={base}"):
                if live.get(b) != base:
                    remove_folder(spark, f"{folder}/base={base}/bucket={b}")


def _buckets(spark: SparkSession, folder: str) -> list[str]:
    return [n.split("=", 1)[1] for n in sub_folders(spark, folder) if n.startswith("bucket=")]


def _live_buckets(spark: SparkSession, folder: str, until: int | None = None) -> dict[str, int]:
    """For each bucket the base that holds its newest rows."""
    live: dict[str, int] = {}
    for base in complete_versions(spark, folder, "base"):
        if until is None or base <= until:
            live.update(dict.fromkeys(_buckets(spark, f"{folder}/base={base}"), base))
    return live


def bucket_names(spark: SparkSession, folder: str) -> set[str]:
    """Every bucket that a base or the changes after it hold."""
    names = set(_live_buckets(spark, folder))
    for epoch in complete_versions(spark, folder, "epoch"):
        names.update(_buckets(spark, f"{folder}/epoch={epoch}"))
    return names


def read_changes(spark: SparkSession, folder: str, keys: Sequence[str],
                 buckets: Sequence[str] | None = None, until: int | None = None,
                 like: DataFrame | None = None) -> DataFrame:
    """Newest row per key over the base of each bucket and the epochs after it.

    ``buckets`` reads only these; ``until`` leaves out epochs after that one. Where no
    row has been written yet, the result is an empty table with the columns of ``like``.
    """
    bases = [b for b in complete_versions(spark, folder, "base") if until is None or b <= until]
    epochs = complete_versions(spark, folder, "epoch")
    after = [e for e in epochs if (not bases or e > bases[-1]) and (until is None or e <= until)]
    rows = _newest_rows(spark, folder, keys, bases, after, buckets)
    if rows is not None:
        return rows.drop("bucket")
    if like is not None:
        return like.limit(0)
    for version in [f"base={b}" for b in bases] + [f"epoch={e}" for e in epochs]:
        if _buckets(spark, f"{folder}/{version}"):
            return spark.read.parquet(f"{folder}/{version}").drop("bucket").limit(0)
    raise FileNotFoundError(f"no committed row in {folder}")


def _newest_rows(spark: SparkSession, folder: str, keys: Sequence[str], bases: list[int],
                 after: list[int], buckets) -> DataFrame | None:
    """Newest row per key, with its bucket; None if no file holds any of the buckets."""
    def wanted(b: str) -> bool:
        return buckets is None or b in buckets

    paths = [f"{folder}/epoch={e}/bucket={b}" for e in after
             for b in _buckets(spark, f"{folder}/epoch={e}") if wanted(b)]
    live = _live_buckets(spark, folder, bases[-1]) if bases else {}
    paths += [f"{folder}/base={base}/bucket={b}" for b, base in live.items() if wanted(b)]
    if not paths:
        return None
    rows = (spark.read.parquet(*paths)
            .withColumn("_path", F.col("_metadata.file_path")))
    epoch = F.regexp_extract("_path", r"/(?:epoch|base)=(\d+)/bucket=", 1).cast("long")
    # A change of the same epoch as a base is already in it, so either will do.
    newest = W.partitionBy("bucket", *keys).orderBy(F.desc("_epoch"))
    return (rows.withColumns({"_epoch": epoch,
                              "bucket": F.regexp_extract("_path", "/bucket=([^/]*)/", 1)})
            .drop("_path")
            .withColumn("_rank", F.row_number().over(newest))
            .filter(F.col("_rank") == 1).drop("_rank", "_epoch"))
