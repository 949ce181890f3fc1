"""Whitening against the plain double-precision solver and exact sums."""

import numpy as np
import pytest
from conftest import MEDIUM
from pyspark.sql import functions as F

from gatewatch.llm import queries, whitening
from gatewatch.llm.whitening import refined_eigenvectors, whiten


@pytest.mark.parametrize("values", [
    [1, 1 + 1e-9, 1 + 2e-9, 2, 3, 3, 5, 8], [1] * 8, list(range(1, 65)), [1e-12, 1e-6, 1, 1e6],
    [5, 5 + 1e-13, 5 - 1e-13, 1], [0, 0, 0, 1], [0, 0]])
def test_eigenvectors_in_double_precision(values):
    rng = np.random.default_rng(len(values))
    turn = np.linalg.qr(rng.normal(size=(len(values),) * 2))[0]
    a = (turn * np.array(values, float)) @ turn.T
    a = (a + a.T) / 2
    x = refined_eigenvectors(a)
    found = np.diag(x.T @ a @ x)
    size = max(np.abs(a).max(), 1e-300)
    assert np.abs(x.T @ x - np.eye(len(a))).max() < 1e-13
    assert np.abs(a @ x - x * found).max() < 1e-14 * len(a) * size
    assert np.abs(np.sort(found) - np.linalg.eigvalsh(a)).max() < 1e-13 * len(a) * size


def test_float32_alone_would_not_do():
    rng = np.random.default_rng(5)
    turn = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    a = (turn * np.linspace(1, 2, 40)) @ turn.T
    plain = np.linalg.eigh(a.astype(np.float32))[1].astype(float)

    def wrong(x):
        return np.abs(a @ x - x * np.diag(x.T @ a @ x)).max()
    assert wrong(plain) > 1e-8 and wrong(refined_eigenvectors((a + a.T) / 2)) < 1e-14


def expected(vectors, components=32):
    x = np.floor(64 * np.array(vectors, float)).astype(int) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    z = (n * x - sums) / n
    covariance = z.T @ z / n
    e, v = np.linalg.eigh(covariance)
    e, v = e[::-1][:components], v[:, ::-1][:, :components]
    return ((n * x - sums) ** 2).sum(axis=1), z @ v / np.sqrt(e), e / np.trace(covariance)


def test_query_equals_brute_force(spark):
    rows = queries.op11_whitening(spark, MEDIUM).toPandas()
    given = spark.read.parquet(f"{MEDIUM}/embeddings.parquet").orderBy("vec_id").toPandas()
    deviation, white, explained = expected(given["embedding"].tolist())
    rows = rows.sort_values(["vec_id", "component"])
    assert rows["vec_id"].tolist() == np.repeat(given["vec_id"], 32).tolist()
    assert rows["component"].tolist() == list(range(1, 33)) * len(given)
    assert (rows["n"] == len(given)).all()
    assert rows["deviation"].tolist() == np.repeat(deviation, 32).tolist()
    got = rows["whitened"].to_numpy().reshape(-1, 32)
    sign = np.sign((got * white).sum(axis=0))
    assert np.abs(got - sign * white).max() < 1e-9
    assert np.abs(rows["explained"].to_numpy().reshape(-1, 32) - explained).max() < 1e-12
    assert rows["identity_error"].nunique() == 1 and rows["identity_error"].max() < 1e-12
    assert np.abs(np.cov(got.T, bias=True) - np.eye(32)).max() < 1e-12


def test_awkward_vectors(spark):
    rng = np.random.default_rng(3)
    fine = [(k, rng.normal(size=3).tolist()) for k in range(40)]
    odd = [(100, None), (101, [1.0, None, 2.0]), (102, [1.0, float("nan"), 2.0]), (103, []),
           (104, [float("inf"), 0.0, 0.0]), (105, [1e300, 0.0, 0.0]), (106, [1.0, 2.0])]
    more = [fine[0], fine[0], (None, [0.5, 0.5, 0.5])]
    df = spark.createDataFrame(fine + odd + more, "vec_id long, embedding array<double>")
    df = df.withColumns({n: F.lit("mine") for n in ("id", "v", "n", "component", "length", "k")})
    out = whiten(df.coalesce(3)).toPandas()
    three = out[out["n"] == 43]
    assert sorted(three["component"].unique()) == [1, 2, 3] and len(three) == 43 * 3
    assert len(three[three["vec_id"] == 0]) == 9 and three["vec_id"].isna().sum() == 3
    deviation, white, _ = expected([v for _, v in fine + more])
    assert sorted(three["deviation"].unique()) == sorted(set(deviation.tolist()))
    assert three["identity_error"].max() < 1e-12
    # The one vector of another length is a list of its own, without spread.
    alone = out[out["n"] == 1]
    assert alone["vec_id"].tolist() == [106, 106] and alone["whitened"].isna().all()
    assert alone["deviation"].tolist() == [0, 0] and alone["explained"].tolist() == [0, 0]
    assert whiten(df.limit(0)).count() == 0
    assert set(out["vec_id"].dropna()).isdisjoint(range(100, 106))


def test_far_and_constant_dimensions(spark):
    rows = [(k, [1e9 + k % 7, -3.0, float(k % 2)]) for k in range(70)]
    out = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).toPandas()
    deviation, white, _ = expected([v for _, v in rows], 2)
    by_id = out.sort_values(["vec_id", "component"])
    assert by_id["deviation"].tolist() == np.repeat(deviation, 3).tolist()
    got = by_id["whitened"].to_numpy().reshape(-1, 3)
    assert np.isnan(got[:, 2]).all()
    assert np.abs(np.abs(got[:, :2]) - np.abs(white)).max() < 1e-9


def test_deviation_beyond_a_long_is_null(spark):
    rows = [(0, [0.0]), (1, [1e13]), (2, [1.0])]
    out = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert {r["vec_id"]: r["deviation"] for r in out.collect()} == dict.fromkeys(range(3))


def test_sums_do_not_depend_on_partitions(spark):
    df = spark.read.parquet(f"{MEDIUM}/embeddings.parquet")
    one, many = (whitening.fit(df.repartition(k)) for k in (1, 13))
    for d, basis in one.items():
        assert basis.rests == many[d].rests
        assert np.array_equal(basis.vectors, many[d].vectors)
