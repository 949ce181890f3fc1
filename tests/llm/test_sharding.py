"""Shards: counts, slots, reproducibility, and the same by SQL."""

import collections

import duckdb
import pytest
from brute import awkward
from conftest import MEDIUM, plan_of, rows_of
from pyspark.sql import functions as F

from gatewatch.llm import queries, sharding


def check(rows, shards, n):
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    sizes = [len(slots[s]) for s in range(shards)]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1
    assert set(slots) <= set(range(shards))
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


@pytest.mark.parametrize("n", [1, 2, 5, 24, 25, 97, 1000, 4099])
def test_counts_and_slots(spark, n):
    rows = spark.range(n).select(F.col("id").alias("doc_id"))
    got = sharding.shuffle_shards(rows, 24, buckets=16).collect()
    check(got, 24, n)
    if n > 500:  # neither in order nor in blocks
        by_id = [r["shard"] for r in sorted(got, key=lambda r: r["doc_id"])]
        assert len(set(by_id[:48])) > 12 and by_id != sorted(by_id)


def test_grid_leaves_few_positions_outside(spark):
    sizes = [1, 2, 3, 7, 31, 1000, 65537, 10**6 + 3, 10**9 + 7, 10**12 + 39]
    rows = spark.createDataFrame([(n,) for n in sizes], "n long")
    for r in rows.select("n", *(c.alias(x) for c, x in zip(
            sharding.radices(F.col("n")), ("height", "width")))).collect():
        assert 0 <= r["height"] * r["width"] - r["n"] <= sharding.OUTSIDE
        assert r["height"] ** 2 >= r["n"] / 4 or r["n"] < 8


def test_permutation_is_one_to_one(spark):
    rows = spark.range(6 * 7).select(
        sharding.permuted(F.col("id"), F.lit(6).cast("long"), F.lit(7).cast("long"), 3).alias("p"))
    assert sorted(r["p"] for r in rows.collect()) == list(range(42))


def test_result_depends_on_the_rows_alone(spark):
    rows = spark.range(500).select(F.col("id").alias("doc_id"), (F.col("id") % 7).alias("size"))
    one = rows_of(sharding.shuffle_shards(rows, 5))
    assert rows_of(sharding.shuffle_shards(rows.repartition(13), 5)) == one
    assert rows_of(sharding.shuffle_shards(rows, 5, seed=1)) != one


def test_awkward_rows(spark):
    df = awkward(spark).withColumns({"shard": F.lit("x"), "slot": F.lit("y")})
    got = sharding.shuffle_shards(df, 3)
    check(got.collect(), 3, df.count())
    assert got.columns == [*(c for c in df.columns if c not in ("shard", "slot")), "shard", "slot"]
    assert sharding.shuffle_shards(df.limit(0), 3).collect() == []
    many = spark.createDataFrame([(1, "a")] * 1000 + [(None, None)] * 3, "doc_id long, t string")
    check(sharding.shuffle_shards(many, 7).collect(), 7, 1003)
    sizes = df.select(sharding.text_size(F.col("text")).alias("n"),
                      sharding.text_crc32(F.col("text")).alias("c"), "doc_id").collect()
    assert {(r["n"], r["c"]) for r in sizes if r["doc_id"] in (1, 2)} == {(0, 0)}


def test_native_and_equal_to_sql(spark):
    df = queries.op2_feistel_shards(spark, MEDIUM)
    assert not any(w in plan_of(df) for w in ("Python", "Pandas", "Arrow"))
    check(df.collect(), 24, 1000)
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{MEDIUM}/documents.parquet'")
    result = connection.execute(queries.OP2_SQL)
    names = [c[0] for c in result.description]
    rows = [dict(zip(names, r)) for r in result.fetchall()]
    assert sorted(tuple(repr(r[n]) for n in sorted(names)) for r in rows) == rows_of(df)
