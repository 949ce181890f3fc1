"""Neighbours against all inner products."""

from dataclasses import replace

import numpy as np
import pytest
from conftest import MEDIUM
from pyspark.sql import functions as F

from gatewatch.llm import neighbours, queries
from gatewatch.llm.neighbours import Settings, probe_sets


def exact(rows, is_query, k):
    """(query, rank, id, score) by brute force; rows of (id, vector)."""
    out = {}
    for q, v in rows:
        if is_query(q):
            scored = [(-float(np.sum(np.array(v) * np.array(x))), i) for i, x in rows]
            scored.remove((-float(np.sum(np.array(v) * np.array(v))), q))
            out[q] = [(i, -s) for s, i in sorted(scored)[:k]]
    return out


def recall(got, expected):
    found = {}
    for r in got:
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hits = total = 0
    for q, best in expected.items():
        ranked = sorted(found[q])
        assert [r for r, _, _ in ranked] == list(range(1, len(best) + 1))
        scores = [s for _, _, s in ranked]
        assert scores == sorted(scores, reverse=True)
        for (_, a, s), (_, b, t) in zip(ranked, ranked[1:]):
            assert s > t or a < b
        hits += len({i for i, _ in best} & {i for _, i, _ in ranked})
        total += len(best)
    return hits / total


@pytest.mark.parametrize("chunk_rows", [4096, 40])
def test_whole_table(spark, chunk_rows):
    rows = [(r["vec_id"], [float(x) for x in r["embedding"]])
            for r in spark.read.parquet(f"{MEDIUM}/embeddings.parquet").collect()]
    expected = exact(rows, lambda i: i % 20 == 0, 20)
    if chunk_rows == 4096:
        got = queries.op6_neighbours(spark, MEDIUM).collect()
    else:
        got = neighbours.nearest(spark.read.parquet(f"{MEDIUM}/embeddings.parquet"),
                                 F.col("id") % 20 == 0, 20,
                                 settings=Settings(chunk_rows=chunk_rows)).collect()
    assert recall(got, expected) >= 0.9
    vectors = dict(rows)
    for r in got:
        assert r["score"] == float(np.sum(
            np.array(vectors[r["query_id"]]) * np.array(vectors[r["vec_id"]])))


def test_probes_come_in_order_of_their_score():
    depths = np.array([0.3, 1.1, 0.9])
    sets = probe_sets(depths, 2.0, 27)
    assert sets[0] == [] and len(sets) == 27
    assert len({tuple(sorted(s)) for s in sets}) == 27
    cost = [sum(depths[i] ** 2 if d < 0 else (2 - depths[i]) ** 2 for i, d in s) for s in sets]
    assert cost == sorted(cost)
    assert probe_sets(depths, 2.0, 4) == sets[:4]


def test_lengths_differ_so_the_largest_product_is_not_the_closest(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(size=8) * rng.choice([0.1, 1, 5])).tolist()) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.nearest(df, F.col("id") % 20 == 0, 5).collect()
    assert recall(got, exact(rows, lambda i: i % 20 == 0, 5)) >= 0.9


def test_copies_ties_and_unusable_vectors(spark):
    rows = [(i, [1.0, 0.0, 2.0]) for i in range(60)]  # copies, three of them queries
    rows += [(i, [0.0, float(i), 1.0]) for i in range(100, 106)]
    bad = [(200, None), (220, [0.0, 0.0, 0.0]), (240, [1.0, None, 2.0]),
           (260, [float("nan"), 1.0, 1.0]), (280, [float("inf"), 1.0, 1.0]), (None, [1.0, 1.0, 1.0]),
           (300, [1.0, 2.0]), (320, [])]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>").withColumns(
        {c: F.lit("mine") for c in ("id", "vector", "table", "query", "member")})
    wide = Settings(width=1000.0)  # one bucket, so that all is found
    got = neighbours.nearest(df, F.col("id") % 20 == 0, 20, settings=wide).collect()
    expected = exact(rows, lambda i: i % 20 == 0, 20)
    assert {r["query_id"] for r in got} == {0, 20, 40, 100} == set(expected)
    for q, best in expected.items():
        mine = sorted((r["rank"], r["vec_id"]) for r in got if r["query_id"] == q)
        assert [i for _, i in mine] == [i for i, _ in best]
    few = neighbours.nearest(df.where("vec_id in (0, 1, 100)"), F.col("id") == 0, 20,
                             settings=wide).collect()
    assert sorted((r["rank"], r["vec_id"]) for r in few) == [(1, 1), (2, 100)]
    assert neighbours.nearest(df.limit(0), F.col("id") == 0).collect() == []


def test_rows_that_repeat_an_id(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.5, 0.1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.nearest(df, F.col("id") == 0, 5, settings=Settings(width=1000.0)).collect()
    assert sorted((r["rank"], r["vec_id"]) for r in got) == [(1, 0), (1, 0), (2, 1), (2, 1)]


def spheres(n, dim=64, seed=3):
    x = np.random.default_rng(seed).normal(size=(n, dim))
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


@pytest.mark.parametrize("changed", [{}, {"coarse": 2, "functions": 6, "width": 2.0}])
@pytest.mark.parametrize("lengths", ["one longer", "lognormal"])
def test_lengths_differ_in_many_dimensions(spark, lengths, changed):
    x = spheres(2000)
    if lengths == "lognormal":
        x *= np.random.default_rng(4).lognormal(size=(len(x), 1))
    else:
        x[7] *= 5
    rows = list(enumerate(x.tolist()))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.nearest(df, F.col("id") % 20 == 0, 20,
                             settings=Settings(**changed)).collect()
    assert recall(got, exact(rows, lambda i: i % 20 == 0, 20)) >= 0.9


def test_the_chance_of_a_visit_grows_with_the_cosine():
    fixed = Settings(functions=6, width=2.0, coarse=2)
    chances = [neighbours.sure_cosine(replace(fixed, recall=r)) for r in (0.5, 0.9, 0.99)]
    assert chances == sorted(chances) and -1 < chances[0] < chances[2] < 1
    assert neighbours.sure_cosine(replace(fixed, probes=1, width=0.1)) == 1


@pytest.mark.parametrize("changed", [{}, {"functions": 4, "width": 0.4}])
def test_lists_are_whole_with_the_settings_in_use(spark, changed):
    def found(rows, step):
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        got = neighbours.nearest(df, F.col("id") % step == 0, 20,
                                 settings=Settings(**changed)).collect()
        ranked = {}
        for r in sorted(got, key=lambda r: r["rank"]):
            ranked.setdefault(r["query_id"], []).append(r["vec_id"])
        return ranked

    few = list(enumerate(spheres(15).tolist()))
    assert found(few, 1) == {q: [i for i, _ in best]
                             for q, best in exact(few, lambda i: True, 20).items()}
    pair = [(0, [1.0, 0.0, 0.0]), (1, [-1.0, 0.0, 0.0])]  # as far apart as can be
    assert found(pair, 2) == {0: [1]}
    copies = [(i, [1.0, 0.0, 2.0]) for i in range(60)] + [(60, [0.0, 5.0, 1.0])]
    assert found(copies, 20) == {q: [i for i in range(22) if i != q][:20] for q in (0, 20, 40)} | {
        60: list(range(20))}


def test_other_dimensions_are_tables_of_their_own(spark):
    rows = [(i, v + [0.0] * (i == 3)) for i, v in enumerate(spheres(30, 8).tolist())]
    rows += [(i, v) for i, v in enumerate(spheres(30, 5).tolist(), 100)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for changed in ({}, {"chunk_rows": 9}):
        got = neighbours.nearest(df, F.col("id") % 10 == 0, 5,
                                 settings=Settings(**changed)).collect()
        assert {r["query_id"] for r in got} == {0, 10, 20, 100, 110, 120}
        for dim in (8, 5):
            table = [(i, v) for i, v in rows if len(v) == dim]
            mine = [r for r in got if r["query_id"] in dict(table)]
            assert recall(mine, exact(table, lambda i: i % 10 == 0, 5)) >= 0.9


def clustered(n=10_000, clusters=100, dim=64, seed=6):
    """Tight clusters of unit vectors."""
    rng = np.random.default_rng(seed)
    x = spheres(clusters, dim, seed)[rng.integers(0, clusters, n)] + rng.normal(
        size=(n, dim)) * 0.02
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def visited(x, settings, asked=40):
    """Share of all vectors that the probes of some of them visit, and the recall of 20."""
    directions, shifts = neighbours.hashes(settings, x.shape[1] + 1)
    up, queries = neighbours.lifted(x, 1.0), np.hstack([x[:asked], np.zeros((asked, 1))])
    seen = np.zeros((asked, len(x)), bool)
    for t in range(settings.tables):
        cells = np.floor((up @ directions[t] + shifts[t]) / settings.width)
        f = queries @ directions[t] + shifts[t]
        for k in range(asked):
            for bucket in neighbours._probed(f[k], np.floor(f[k] / settings.width), settings):
                seen[k] |= (cells == bucket).all(axis=1)
    best = np.argsort(-(queries @ up.T), axis=1)[:, 1:21]
    return seen.mean(), np.take_along_axis(seen, best, axis=1).mean()


def test_settings_follow_the_data():
    """Few vectors are visited where there are clusters, and the recall stays."""
    x = clustered()
    fitted = neighbours.chosen(neighbours.lifted(x[:4096], 1.0), len(x), 20, Settings())
    share, found = visited(x, fitted)
    assert share <= 0.15 and found >= 0.9
    plain = spheres(3000)
    fitted = neighbours.chosen(neighbours.lifted(plain, 1.0), len(plain), 20, Settings())
    assert visited(plain, fitted)[1] >= 0.9


def test_clusters_are_found_by_the_hash(spark):
    x = clustered(6000, 60)
    rows = list(enumerate(x.tolist()))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asks = [i for i in range(6000) if i % 100 == 0]
    got = neighbours.nearest(df, F.col("id") % 100 == 0, 20).collect()
    products = x[asks] @ x.T
    hits = 0
    for k, q in enumerate(asks):
        order = [i for i in np.argsort(-products[k], kind="stable") if i != q][:20]
        hits += len(set(order) & {r["vec_id"] for r in got if r["query_id"] == q})
    assert hits / (20 * len(asks)) >= 0.9


def test_more_rows_are_parted_by_more_functions():
    sample = neighbours.lifted(spheres(500), 1.0)
    fixed = Settings(functions=10, width=1.0)
    coarse = [neighbours.chosen(sample, n, 20, fixed).coarse for n in (500, 10**6, 10**9)]
    assert coarse == sorted(coarse) and coarse[0] < coarse[2] <= 10


def test_rows_per_query_do_not_grow_with_the_cell(spark):
    """A query's best of a cell come from one task, also where the cell has many members."""
    rows = spark.range(10_000).selectExpr("id", "array(sin(id), cos(3 * id)) AS vector")
    cell = F.lit(0)
    asked = neighbours._whole(rows.where("id < 3"), cell, queries=True)
    for n in (2_000, 10_000):
        index = neighbours._whole(rows.where(F.col("id") < n), cell)
        assert neighbours._search(index, asked, Settings(), 21).count() == 3 * 21
    # Cut into chunks, with the same best ones.
    cut = neighbours._search(index, asked, Settings(chunk_rows=100), 21)
    assert cut.count() > 3 * 21
    whole = neighbours._search(index, asked, Settings(), 21)
    best = [sorted((r["query"], r["place"], r["member"], r["score"])
                   for r in neighbours._best(found, 21).collect()) for found in (cut, whole)]
    assert best[0] == best[1]
