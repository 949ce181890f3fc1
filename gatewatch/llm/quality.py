"""Quality scores: ridge regression on random Fourier features, then isotonic calibration."""

from __future__ import annotations

import math
import string
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from gatewatch.llm.common import annotate
from gatewatch.llm.components import cut_lineage

_PUNCTUATION = string.punctuation.encode()
_ENDS = (".", "!", "?", ":", ";", "…", "\"", "”")
_UPPER, _LOWER, _DIGIT = (string.ascii_uppercase.encode(), string.ascii_lowercase.encode(),
                          string.digits.encode())

_NOT_ASCII = bytes(range(128, 256))


@dataclass(frozen=True)
class Settings:
    features: int = 192
    width: float = 6.0
    ridge: float = 1e-3
    bins: int = 2000
    seed: int = 11


def statistics(text: str) -> list[float]:
    """Statistics of a whole text that do not depend on its language; 0 for an empty text."""
    data = text.encode()
    size = max(len(data), 1)
    words = data.split()
    n = max(len(words), 1)
    lines = [x for x in text.split("\n") if x.strip()]
    counts = Counter(words)
    top = max(counts.values(), default=0)
    lengths = [len(w) for w in words] or [0]
    mean = sum(lengths) / n
    spread = math.sqrt(max(sum(x * x for x in lengths) / n - mean * mean, 0))
    bare = len(data.translate(None, _PUNCTUATION))
    odd = size - len(data.translate(None, b"#$%&*|@~^<>{}[]=+_\\/"))
    upper = len(data) - len(data.translate(None, _UPPER))
    lower = len(data) - len(data.translate(None, _LOWER))
    digits = len(data) - len(data.translate(None, _DIGIT))
    line_counts = Counter(lines)
    lines_n = max(len(lines), 1)
    return [
        math.log1p(len(data)), math.log1p(len(words)), math.log1p(len(lines)),
        min(mean, 40.0), min(spread, 40.0), math.log1p(max(lengths)),
        upper / size, math.sqrt(upper / max(upper + lower, 1)), math.sqrt(digits / size),
        math.sqrt((len(data) - bare) / size), math.sqrt(odd / size),
        math.sqrt(data.count(b"!") / n), math.sqrt(data.count(b"|") / n),
        (len(data) - len(data.translate(None, _NOT_ASCII))) / size,
        len(counts) / n, len(counts) / math.sqrt(n), top / n,
        sum(map(bytes.__eq__, words, words[1:])) / n,
        1 - len(line_counts) / lines_n, math.log1p(size / lines_n),
        sum(x.rstrip().endswith(_ENDS) for x in lines) / lines_n,
        sum(x.lstrip()[:1].isupper() for x in lines) / lines_n,
        math.sqrt(sum(not w.translate(None, _PUNCTUATION) for w in words) / n),
        data.count(b"http") / n, data.count(b"\n") / n,
        1 - len(set(zip(words, words[1:], words[2:]))) / max(len(words) - 2, 1),
    ]


@dataclass
class Model:
    settings: Settings
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    knots: np.ndarray  # raw scores, ascending
    values: np.ndarray  # calibrated scores at the knots

    def projection(self) -> tuple[np.ndarray, np.ndarray]:
        return _projection(self.settings, len(self.mean))

    def raw(self, x: np.ndarray) -> np.ndarray:
        return _features(x, self.mean, self.scale, *self.projection()) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = self.raw(x)
        steps = np.interp(raw, self.knots, self.values) if len(self.knots) else np.full(
            len(raw), 0.5)
        # A trace of the raw score keeps the order inside a calibrated step.
        return np.clip(0.99 * steps + 0.01 / (1 + np.exp(-raw)), 0, 1)


def _projection(s: Settings, n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(s.seed)
    return (rng.normal(0, 1 / s.width, (n, s.features)),
            rng.uniform(0, 2 * np.pi, s.features))


def _features(x, mean, scale, directions, shifts) -> np.ndarray:
    """Cosines whose inner products approximate a Gaussian kernel, and a constant."""
    z = np.clip((x - mean) / scale, -8, 8) @ directions + shifts
    return np.hstack([np.sqrt(2 / len(shifts)) * np.cos(z), np.ones((len(x), 1))])


def add_statistics(df: DataFrame, text_col: str = "text", out: str = "statistics") -> DataFrame:
    return annotate(df, text_col, [StructField(out, ArrayType(DoubleType()))],
                    lambda: lambda texts: [[statistics(t) for t in texts]])


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), np.float64)


def fit(rows: DataFrame, label_col: str, statistics_col: str = "statistics",
        settings: Settings = Settings()) -> Model:
    """A model fitted on all rows with a label.

    Means, spreads and the normal equations are sums that each partition adds
    up for itself; per partition only ``features``² / 2 numbers are shuffled, and
    as many reach the driver in the end. The calibration sees counts per bin of
    the raw score. Without labelled rows every score is the same.
    """
    known = rows.where(F.col(label_col).isNotNull()).select(
        F.col(statistics_col).alias("x"), F.col(label_col).cast("double").alias("y"))
    width = len(statistics(""))
    moments = known.select(F.posexplode("x").alias("k", "v")).groupBy("k").agg(
        F.avg("v").alias("m"), F.stddev_pop("v").alias("s")).collect()
    mean, scale = np.zeros(width), np.ones(width)
    for r in moments:
        mean[r.k], scale[r.k] = r.m, max(r.s, 1e-6)
    directions, shifts = _projection(settings, width)
    size = settings.features + 1
    upper = np.triu_indices(size)

    def equations(batches):
        total = np.zeros((size, size + 2))
        for batch in batches:
            if batch.num_rows:
                z = _features(_matrix(batch.column("x")), mean, scale, directions, shifts)
                y = batch.column("y").to_numpy()
                total[:, :size] += z.T @ z
                total[:, size] += z.T @ y
        values = np.concatenate([total[:, :size][upper], total[:, size]])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)],
                                         names=["k", "v"])

    sums = (known.mapInArrow(equations, "k bigint, v double")
            .groupBy("k").agg(F.sum("v").alias("v")).toArrow())
    values = np.zeros(len(upper[0]) + size)
    values[sums["k"].to_numpy()] = sums["v"].to_numpy()
    left = np.zeros((size, size))
    left[upper] = values[:len(upper[0])]
    left = left + np.triu(left, 1).T
    n = left[-1, -1]
    penalty = np.full(size, settings.ridge * max(n, 1) / settings.features)
    penalty[-1] = 1e-9
    weights = np.linalg.solve(left + np.diag(penalty), values[len(upper[0]):])
    model = Model(settings, mean, scale, weights, np.zeros(0), np.zeros(0))

    def binned(batches):
        for batch in batches:
            if batch.num_rows:
                raw = np.clip(model.raw(_matrix(batch.column("x"))), -1, 2)
                at = np.round((raw + 1) / 3 * settings.bins).astype(np.int64)
                count = np.bincount(at, minlength=settings.bins + 1)
                ones = np.bincount(at, batch.column("y").to_numpy(), settings.bins + 1)
                some = np.flatnonzero(count)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some), pa.array(count[some]), pa.array(ones[some])],
                    names=["k", "n", "y"])

    bins = (known.mapInArrow(binned, "k bigint, n bigint, y double").groupBy("k")
            .agg(F.sum("n").alias("n"), F.sum("y").alias("y")).toArrow().sort_by("k"))
    return _calibrated(model, bins["k"].to_numpy(), bins["n"].to_numpy().astype(float),
                       bins["y"].to_numpy())


def _calibrated(model: Model, at: np.ndarray, n: np.ndarray, y: np.ndarray) -> Model:
    """Neighbouring bins that violate the order are pooled; knots are the pools' middles."""
    pools: list[list[float]] = []  # rows, ones, sum of raw scores
    for k, rows, ones in zip(at / model.settings.bins * 3 - 1, n, y):
        pools.append([rows, ones, rows * k])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    model.knots = np.array([p[2] / p[0] for p in pools])
    # Half a row of each label keeps small pools off 0 and 1.
    model.values = np.maximum.accumulate(
        np.array([(p[1] + 0.5) / (p[0] + 1) for p in pools] or [0.5]))[:len(pools)]
    return model


def score(rows: DataFrame, model: Model, statistics_col: str = "statistics",
          out: str = "score") -> DataFrame:
    """``rows`` with a score from 0 to 1 in place of the statistics."""
    kept = [c for c in rows.columns if c.lower() not in (out.lower(), statistics_col.lower())]
    schema = StructType([rows.schema[c] for c in kept] + [StructField(out, DoubleType())])

    def run(batches):
        for batch in batches:
            x = batch.column(statistics_col)
            found = model.score(_matrix(x)) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + [pa.array(found)], names=[*kept, out])

    return rows.select(*(F.col(f"`{c}`") for c in [*kept, statistics_col])).mapInArrow(run, schema)


def learn_and_score(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                    text_col: str = "text", label_col: str = "quality",
                    settings: Settings = Settings()) -> DataFrame:
    """(id, score) for every row of ``documents``, learned from ``labels``.

    The statistics are computed once, written to the shared checkpoint folder
    and used for both fitting and scoring; texts are never shuffled. Null ids
    and labels teach nothing but are scored; an id's greatest label counts; null
    texts count as empty; repeated rows come out once each.
    """
    rows = cut_lineage(add_statistics(
        documents.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")),
        "text").drop("text"))
    known = (labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
             .agg(F.max(F.col(label_col)).alias("label")))
    model = fit(rows.join(known, "id"), "label", settings=settings)
    return score(rows, model).withColumnRenamed("id", id_col)
