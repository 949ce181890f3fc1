"""Connected components of a graph given by links, with joins and minima alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewatch.sources.folders import shared_folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read from there.

    Uses ``spark.checkpoint.dir``; where a session has none (local tests), a
    folder below its warehouse takes its place.
    """
    spark = df.sparkSession
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def _state(edges: DataFrame) -> tuple:
    """Number and checksum of the distinct links."""
    return tuple(edges.agg(F.count("*"), F.sum(
        F.xxhash64("v", "u").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b: long), root its component's least node.

    Alternates two steps until nothing changes: each node's larger neighbours
    are linked to its least one, then each node's smaller neighbours and itself
    are. Rounds grow with the logarithm of a component's size. Only the number
    and a checksum of the links reach the driver. Minima are pre-aggregated, and
    the joins back are plain equi-joins, whose hot keys Spark splits.
    """
    edges = cut_lineage(links.where("a <> b")
                        .select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u"))
                        .distinct())
    seen = _state(edges)
    while seen[0]:
        both = edges.select(F.col("v").alias("x"), F.col("u").alias("y")).unionByName(
            edges.select(F.col("u").alias("x"), F.col("v").alias("y")))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select(
            "x", F.least("x", "m").alias("m"))
        large = (both.join(least, "x").where("y > x and y <> m")
                 .select(F.col("y").alias("v"), F.col("m").alias("u")).distinct())
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(least, "v")
        edges = cut_lineage(
            small.select("v", F.col("m").alias("u"))
            .unionByName(small.where("u <> m").select(F.col("u").alias("v"),
                                                      F.col("m").alias("u")))
            .distinct())
        before, seen = seen, _state(edges)
        if before == seen:
            break
    return edges.select(F.col("v").alias("node"), F.col("u").alias("root")).unionByName(
        edges.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())
