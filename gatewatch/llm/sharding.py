"""Reproducible shuffle into shards: a Feistel permutation of global row numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROUNDS = 6
# Positions outside the table that the permutation may have: so many steps of
# cycle walking lead back inside for certain, as a walk visits none twice.
OUTSIDE = 32
BUCKETS = 4096
# Fixed value: hex digits of MD5 that fit a positive long.
DIGITS = 15


def text_size(text: Column) -> Column:
    """UTF-8 bytes of a text (null: none)."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def text_crc32(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")))


def digest_number(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, DIGITS), 16, 10).cast("long")


def radices(total: Column) -> tuple[Column, Column]:
    """Sides of a grid near the square with at most OUTSIDE positions beyond ``total``.

    To be called on one row. Where no side in reach fits, one side is 1.
    """
    one = F.lit(1).cast("long")
    root = F.greatest(one, F.floor(F.sqrt(total.cast("double"))).cast("long"))
    fits = F.filter(F.sequence(root, F.greatest(one, root - (1 << 20)), -one),
                    lambda a: F.pmod(-total, a) <= OUTSIDE)
    height = F.coalesce(F.try_element_at(fits, F.lit(1)), one)
    return height, divided(total + height - 1, height)


def divided(x: Column, by: Column) -> Column:
    """Whole quotient of numbers from 0."""
    return ((x - F.pmod(x, by)) / by).cast("long")


def row_numbers(rows: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Each row of ``rows`` with ``_number`` from 0, without gaps, ``_total``, and the
    sides ``_height`` and ``_width`` of the grid for all numbers.

    The numbers follow a digest of the row's values and then the values, so they
    depend on the rows alone and not on files, tasks or settings. Equal rows
    are counted before any shuffle and numbered one after the other. Rows meet
    in ``buckets`` windows; only the windows' sizes, ``buckets`` numbers, come
    together in one place and are broadcast. All columns have to be comparable;
    nulls are values.
    """
    columns = [F.col(f"`{c}`") for c in rows.columns]
    text = F.concat_ws(",", *(F.coalesce(c.cast("string"), F.lit("~")) for c in columns))
    counted = (rows.groupBy(*columns).agg(F.count("*").alias("_n"))
               .withColumn("_bucket", F.pmod(digest_number(text), F.lit(buckets)).cast("int")))
    sizes = counted.groupBy("_bucket").agg(F.sum("_n").alias("_size"))
    one = sizes.agg(F.sum("_size").alias("_total"),
                    F.collect_list(F.struct("_bucket", "_size")).alias("_parts"))
    height, width = radices(F.col("_total"))
    starts = (one.select("_total", height.alias("_height"), width.alias("_width"),
                         F.explode("_parts").alias("_part"))
              .select("_total", "_height", "_width", "_part._bucket",
                      (F.sum("_part._size").over(Window.orderBy("_part._bucket"))
                       - F.col("_part._size")).alias("_start")))
    inside = Window.partitionBy("_bucket").orderBy(*columns).rowsBetween(
        Window.unboundedPreceding, 0)
    placed = (counted.withColumn("_before", F.sum("_n").over(inside) - F.col("_n"))
              .join(F.broadcast(starts), "_bucket"))
    first = F.col("_start") + F.col("_before")
    return placed.select(*columns, "_total", "_height", "_width", F.explode(
        F.sequence(first, first + F.col("_n") - 1)).alias("_number"))


def permuted(x: Column, height: Column, width: Column, seed: int) -> Column:
    """One pass of the Feistel network: x = left * width + right, mixed by turns."""
    def mix(turn: Column, half: Column) -> Column:
        return digest_number(F.concat_ws(":", F.lit(str(seed)), turn.cast("string"),
                                         half.cast("string")))

    def both(s: Column, i: Column) -> Column:
        return F.when(i % 2 == 0, F.struct(
            F.pmod(s["left"] + mix(i, s["right"]), height).alias("left"),
            s["right"].alias("right"))).otherwise(F.struct(
                s["left"].alias("left"),
                F.pmod(s["right"] + mix(i, s["left"]), width).alias("right")))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)),
                       F.struct(divided(x, width).alias("left"),
                                F.pmod(x, width).alias("right")),
                       both, lambda s: s["left"] * width + s["right"])


def shuffle_shards(rows: DataFrame, shards: int, seed: int = 42,
                   buckets: int = BUCKETS) -> DataFrame:
    """``rows`` with a random but reproducible ``shard`` and ``slot``.

    Row numbers (see ``row_numbers``) go through a Feistel permutation of the
    grid; the cycle is walked while a position lies beyond the rows. Position p is
    shard p mod shards, slot p div shards: counts differ by one at most, slots
    have no gaps, and both can be computed from a row number. Columns of
    ``rows`` that are named like a result are replaced. An empty table stays
    empty; equal rows get places of their own.
    """
    kept = [c for c in rows.columns if c.lower() not in ("shard", "slot")]
    total, height, width = F.col("_total"), F.col("_height"), F.col("_width")
    position = F.col("_position")
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(OUTSIDE)), position,
        lambda p, _: F.when(p < total, p).otherwise(permuted(p, height, width, seed)))
    return (row_numbers(rows.select(*(F.col(f"`{c}`") for c in kept)), buckets)
            .withColumn("_position", permuted(F.col("_number"), height, width, seed))
            .withColumn("_position", F.when(position < total, position).otherwise(walked))
            .select(*(F.col(f"`{c}`") for c in kept),
                    F.pmod(position, F.lit(shards)).cast("int").alias("shard"),
                    divided(position, F.lit(shards).cast("long")).alias("slot")))


def shards_sql(rows: str, columns: str, text: str, shards: int, seed: int = 42,
               buckets: int = BUCKETS) -> str:
    """``shuffle_shards`` over the SQL table ``rows`` as one DuckDB statement.

    ``text`` is the digest's text of a row, ``columns`` its columns.
    """
    number = f"('0x' || substr(md5({{}}), 1, {DIGITS}))::BIGINT"

    def network(x: str) -> str:
        steps = [f"{x} // width AS l0, {x} % width AS r0"]
        for i in range(ROUNDS):
            mixed = number.format(f"'{seed}:{i}:' || {'r' if i % 2 == 0 else 'l'}{i}")
            steps.append(f"(l{i} + {mixed}) % height AS l{i + 1}, r{i} AS r{i + 1}" if i % 2 == 0
                         else f"l{i} AS l{i + 1}, (r{i} + {mixed}) % width AS r{i + 1}")
        return ", ".join(steps)

    end = f"l{ROUNDS} * width + r{ROUNDS}"
    return f"""
WITH RECURSIVE numbered AS (
  SELECT *, row_number() OVER (ORDER BY {number.format(text)} % {buckets}, {columns}) - 1 AS n,
    count(*) OVER () AS total FROM ({rows})),
side AS (
  SELECT t AS total, coalesce(max(a) FILTER (WHERE (a - t % a) % a <= {OUTSIDE}), 1) AS height
  FROM (SELECT count(*) AS t FROM ({rows})), range(1, 1000000) r(a)
  WHERE a <= floor(sqrt(t)) GROUP BY t),
grid AS (SELECT *, (total + height - 1) // height AS width FROM side),
walk AS (
  SELECT n, total, height, width, {end} AS p FROM (
    SELECT n, total, height, width, {network('n')} FROM numbered JOIN grid USING (total))
  UNION ALL
  SELECT n, total, height, width, {end} AS p FROM (
    SELECT n, total, height, width, {network('p')} FROM walk WHERE p >= total))
SELECT numbered.*, p % {shards} AS shard, p // {shards} AS slot
FROM numbered JOIN walk USING (n) WHERE p < walk.total"""
