"""Importance resampling against a plain version; the radix sort against sorting."""

import collections
import hashlib
import math
import zlib

import numpy as np
import pytest
from brute import awkward, benchmark_words
from pyspark.sql import functions as F

from gatewatch.llm import resampling
from gatewatch.llm.resampling import Settings, ranked, resample


def plain(docs, target, settings):
    def features(text):
        words = benchmark_words(text)
        runs = [" ".join(words[k:k + n]) for n in range(1, settings.grams + 1)
                for k in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(r.encode()) % settings.buckets for r in runs]

    rows = [(i, *features(t)) for i, t in docs]
    s = collections.Counter(b for _, _, f in rows for b in f)
    t = collections.Counter(b for x in target for b in features(x)[1])
    size, all_s, all_t = settings.buckets, sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + size) / ((s[b] + 1) * (all_t + size))))
            for b in range(size)]
    out = []
    for i, n, f in rows:
        text = f"{settings.seed}:{'' if i is None else i}"
        h = int(hashlib.sha256(text.encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append((i, n, len(f), weight,
                    weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    fit = sorted((r for r in out if r[1] >= settings.least_words),
                 key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    take = settings.percent * len(fit) // 100
    return ([(r[0], *r[2:]) for r in out],
            [(r[0], k + 1) for k, r in enumerate(fit[:take])])


def compare(docs, target, settings, got):
    numbers, ranks = plain([(r["doc_id"], r["text"]) for r in docs.collect()],
                           [r["text"] for r in target.collect()], settings)
    rows = got.collect()
    assert sorted(map(repr, numbers)) == sorted(
        repr((r["doc_id"], r["n_features"], r["weight"], r["score"])) for r in rows)
    assert ranks == [(r["doc_id"], r["rank"]) for r in sorted(
        (r for r in rows if r["rank"] is not None), key=lambda r: r["rank"])]


@pytest.mark.parametrize("settings", [
    Settings(buckets=50, least_words=1, percent=60), Settings(grams=2, least_words=0, percent=100)])
def test_awkward_documents(spark, settings):
    docs = awkward(spark).withColumns({n: F.lit("mine") for n in ("rank", "weight", "place", "part")})
    target = spark.createDataFrame([(1, "same words text"), (2, None), (3, "")],
                                   "item_id long, text string")
    got = resample(docs, target, settings=settings)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    compare(docs, target, settings, got)
    compare(docs, target.limit(0), settings, resample(docs, target.limit(0), settings=settings))
    assert resample(docs.limit(0), target, settings=settings).collect() == []


def test_nothing_long_enough(spark):
    docs = spark.createDataFrame([(1, "too short"), (2, None)], "doc_id long, text string")
    rows = resample(docs, docs).collect()
    assert [r["rank"] for r in rows] == [None, None]


def test_drawn_documents_keep_their_columns(spark):
    docs = awkward(spark)
    target = spark.createDataFrame([("tie",)], "text string")
    ranks = resample(docs, target, settings=Settings(least_words=1, percent=50))
    ids = {r["doc_id"] for r in ranks.collect() if r["rank"]}
    got = resampling.drawn(docs, ranks)
    assert got.columns == docs.columns and {r["doc_id"] for r in got.collect()} == ids


@pytest.mark.parametrize("part_rows", [None, 7, 100])
def test_radix_sort_over_many_parts(spark, part_rows):
    """Keys of 40 and 23 bits, one of which a third of the rows share."""
    rng = np.random.default_rng(part_rows or 1)
    high = np.where(rng.random(900) < 0.3, 5 << 30, rng.integers(0, 1 << 40, 900))
    low = rng.integers(0, 1 << 23, 900)
    rows = [(int(a), int(b), "x", int(a) % 3) for a, b in zip(high, low)]
    df = spark.createDataFrame(rows, "a long, b long, place string, n int").repartition(6)
    got = ranked(df, [("a", 40), ("b", 23)], part_rows)
    assert got.columns == ["a", "b", "place", "n", "rank"]
    found = sorted((r["rank"], r["a"], r["b"], r["place"], r["n"]) for r in got.collect())
    assert [r[1:] for r in found] == sorted(rows)
    assert [r[0] for r in found] == list(range(1, 901))


def test_equal_keys_keep_their_order_and_have_places(spark):
    df = spark.range(500, numPartitions=4).selectExpr("id", "id % 2 AS k")
    got = {r["id"]: r["rank"] for r in ranked(df, [("k", 1)], 10).collect()}
    assert [got[i] for i in [*range(0, 500, 2), *range(1, 500, 2)]] == list(range(1, 501))
    same = ranked(df.selectExpr("id", "0 AS k"), [("k", 0)], 10).collect()
    assert sorted(r["rank"] for r in same) == list(range(1, 501))
    assert ranked(df.limit(0), [("k", 1)]).collect() == []


def test_parts_have_equal_sizes_whatever_the_keys(spark):
    """All rows share one key: the sort still deals them evenly."""
    df = spark.range(1000, numPartitions=3).selectExpr("id", "CAST(3 AS BIGINT) AS k")
    places = [r["rank"] - 1 for r in ranked(df, [("k", 12)], 100).collect()]
    assert collections.Counter(p // 100 for p in places) == dict.fromkeys(range(10), 100)


def test_ids_over_the_whole_range_of_longs(spark):
    rows = [(i, "word " * 25) for i in (None, -(1 << 63), -1, 0, 1, (1 << 63) - 1, 1 << 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    settings = Settings(percent=100)
    compare(docs, docs, settings, resample(docs, docs, settings=settings))
