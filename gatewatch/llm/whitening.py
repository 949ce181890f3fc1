"""Whitening of embeddings by principal components refined to double precision."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, IntegerType, LongType, StructField, StructType)

# Entries that do not fit on the grid in exact doubles count as not finite.
GRID_LIMIT = float(1 << 52)
LOW_BITS = 20
PARTS = 64


@dataclass(frozen=True)
class Grid:
    """Entries become whole numbers floor(steps * c) + offset, whose sums are exact."""
    steps: int = 64
    offset: int = 1_000_000

    def numbers(self, values: np.ndarray) -> np.ndarray:
        return np.floor(values * self.steps).astype(np.int64) + self.offset


@dataclass
class Basis:
    """What all vectors of one length share. Eigenvalues fall; a null component has none."""
    rows: int
    floors: np.ndarray      # floor of the mean of each dimension
    rests: list[int]        # sum - rows * floor, from 0 to rows - 1
    eigenvalues: np.ndarray
    vectors: np.ndarray     # columns
    explained: np.ndarray
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.floors) - np.array([r / self.rows for r in self.rests])

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """One column per component; NaN where the eigenvalue is zero."""
        root = np.sqrt(np.where(self.eigenvalues > 0, self.eigenvalues, np.nan))
        return self.centred(x) @ self.vectors / root

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of (rows * x - sum) squared, exact; None where a long can't hold one."""
        near = x - self.floors
        reach = (int(np.abs(near).max(initial=0)) + 1) * self.rows
        if reach * reach * len(self.floors) < 1 << 62:
            apart = self.rows * near - np.array(self.rests, np.int64)
            return (apart * apart).sum(axis=1).tolist()
        apart = self.rows * near.astype(object) - np.array(self.rests, object)
        sums = (apart * apart).sum(axis=1)
        return [int(s) if s < 1 << 63 else None for s in sums]


def _by_length(column: pa.ListArray, grid: Grid) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length the rows that take part and their grid numbers."""
    ends = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)
    with np.errstate(invalid="ignore", over="ignore"):
        bad = ~(np.abs(values * grid.steps) < GRID_LIMIT)
    before = np.concatenate(([0], np.cumsum(bad)))
    lengths = np.diff(ends)
    fine = (before[ends[1:]] == before[ends[:-1]]) & (lengths > 0)
    fine &= column.is_valid().to_numpy(zero_copy_only=False)
    for length in np.unique(lengths[fine]).tolist():
        rows = np.flatnonzero(fine & (lengths == length))
        places = ends[rows][:, None] + np.arange(length)
        yield rows, grid.numbers(values[places])


def _vectors(df: DataFrame, vector_col: str) -> DataFrame:
    return df.select(F.col(f"`{vector_col}`").cast("array<double>").alias("v"))


def _sums(vectors: DataFrame, grid: Grid) -> dict[int, tuple[int, list[int]]]:
    """For each length the number of vectors and the exact sum of each dimension."""
    def add_up(batches):
        found: dict[int, list] = {}
        for batch in batches:
            for rows, x in _by_length(batch.column(0), grid):
                n, high, low = found.get(x.shape[1], (0, 0, 0))
                found[x.shape[1]] = [n + len(rows), high + (x >> LOW_BITS).sum(axis=0),
                                     low + (x & ((1 << LOW_BITS) - 1)).sum(axis=0)]
        for length, (n, high, low) in found.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([length] * length), pa.array(np.arange(length)),
                 pa.array([n] * length), pa.array(high), pa.array(low)],
                names=["length", "k", "n", "high", "low"])

    exact = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "high", "low")]
    out: dict[int, tuple[int, list[int]]] = {}
    for r in (vectors.mapInArrow(add_up, "length long, k long, n long, high long, low long")
              .groupBy("length", "k").agg(*exact).orderBy("length", "k").collect()):
        sums = out.setdefault(r.length, (int(r.n), []))[1]
        sums.append((int(r.high) << LOW_BITS) + int(r.low))
    return out


def _gram(vectors: DataFrame, grid: Grid,
          rows_of: Callable[[np.ndarray], np.ndarray]) -> dict[int, np.ndarray]:
    """For each length the sum of the outer products of ``rows_of`` (grid numbers).

    A task adds up its own rows; the sums of the tasks are added in two steps,
    matrix row by matrix row, so no task holds more than a share of them.
    """
    def add_up(batches):
        part = TaskContext.get().partitionId() % PARTS
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in _by_length(batch.column(0), grid):
                y = rows_of(x)
                found[x.shape[1]] = found.get(x.shape[1], 0) + y.T @ y
        for length, total in found.items():
            k = len(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([length] * k), pa.array(np.arange(k)), pa.array([part] * k),
                 pa.array(list(total), pa.list_(pa.float64()))],
                names=["length", "k", "part", "total"])

    schema = "length long, k long, part long, total array<double>"

    def join(table: pa.Table) -> pa.Table:
        first = table.slice(0, 1).drop_columns(["total"])
        totals = table.column("total").combine_chunks()
        width = len(totals[0])
        total = totals.values.to_numpy().reshape(-1, width).sum(axis=0)
        return first.append_column("total", pa.array([total], pa.list_(pa.float64())))

    sums = (vectors.mapInArrow(add_up, schema)
            .groupBy("length", "k", "part").applyInArrow(join, schema)
            .groupBy("length", "k").applyInArrow(join, schema))
    out: dict[int, np.ndarray] = {}
    for length, k, row in sums.select("length", "k", "total").collect():
        out.setdefault(length, np.zeros((len(row), len(row))))[k] = row
    return out


def refined_eigenvectors(a: np.ndarray, rounds: int = 20) -> np.ndarray:
    """Orthonormal eigenvectors of a symmetric matrix (columns, eigenvalues rising).

    They start as those of the float32 solver. Each round measures how far the
    columns are from orthonormal (r) and from diagonalising (s), and corrects all
    of them by one product of matrices, with quadratic convergence (Ogita and
    Aishima). Pairs whose eigenvalues lie closer than the rounds' own error are only
    made orthogonal; each run of such eigenvalues is then solved as a small
    problem of its own, shifted by its mean so that the differences count.
    """
    scale = np.abs(a).max(initial=0.0)
    if scale == 0:
        return np.eye(len(a))
    a = (a + a.T) / (2 * scale)
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.float64)
    one, size = np.eye(len(a)), np.linalg.norm(a)
    last = np.inf
    for _ in range(rounds):
        r = one - x.T @ x
        s = x.T @ (a @ x)
        r, s = (r + r.T) / 2, (s + s.T) / 2
        values = np.diag(s) / (1 - np.diag(r))
        order = np.argsort(values, kind="stable")
        values, x = values[order], x[:, order]
        r, s = r[np.ix_(order, order)], s[np.ix_(order, order)]
        delta = 2 * (np.linalg.norm(s - np.diag(values)) + size * np.linalg.norm(r))
        gaps = values[None, :] - values[:, None]
        near = np.abs(gaps) <= delta
        change = np.where(near, r / 2, (s + values[None, :] * r) / np.where(near, 1.0, gaps))
        x = x + x @ change
        starts = np.flatnonzero(np.diff(values, prepend=-np.inf) > delta)
        for at, end in zip(starts, [*starts[1:], len(values)]):
            if end - at > 1:
                x[:, at:end] = _sub_solve(a, x[:, at:end], values[at:end].mean())
        moved = np.abs(change).max()
        if moved < 1e-15 or moved >= last < 1e-12:
            break
        last = moved
    for _ in range(2):  # what rounding leaves between columns, by the same product alone
        x = x + x @ (one - x.T @ x) / 2
    return x


def _sub_solve(a: np.ndarray, columns: np.ndarray, shift: float) -> np.ndarray:
    """The same space, with the eigenvectors of the matrix inside it as its basis."""
    base = np.linalg.qr(columns)[0]
    small = base.T @ (a @ base - shift * base)
    return base @ np.linalg.eigh((small + small.T) / 2)[1]


def _basis(rows: int, sums: list[int], floors: np.ndarray, gram: np.ndarray,
           components: int) -> Basis:
    rests = [s - rows * int(q) for s, q in zip(sums, floors)]
    rest = np.array(rests, object)
    # The sum around the floors is exact, and so is the step from floors to means.
    whole = np.array([[int(v) for v in row] for row in gram], object)
    exact = rows * whole - rest[:, None] * rest[None, :]
    covariance = np.array([[v / (rows * rows) for v in row] for row in exact], np.float64)
    vectors = refined_eigenvectors(covariance)[:, ::-1]
    values = np.einsum("ij,ij->j", vectors, covariance @ vectors)
    order = np.argsort(-values, kind="stable")[:components]
    vectors, values = vectors[:, order], values[order]
    largest = np.abs(vectors).argmax(axis=0)
    vectors = vectors * np.sign(vectors[largest, np.arange(len(order))])
    values = np.where(values > len(sums) * 8 * np.finfo(float).eps * values[0], values, 0.0)
    trace = float(np.trace(covariance))
    return Basis(rows, floors, rests, values, vectors, values / trace if trace else values)


def fit(df: DataFrame, vector_col: str = "embedding", components: int = 32,
        grid: Grid = Grid()) -> dict[int, Basis]:
    """A basis for each length of vector, fitted on all vectors of that length.

    Two passes: exact sums, then the covariance with every row centred before it is
    multiplied; a third measures how far the whitened rows are from unit
    covariance. Only sums reach the driver: length² numbers for each length.
    """
    vectors = _vectors(df, vector_col)
    sums = _sums(vectors, grid)
    floors = {d: np.array([s // n for s in total], np.int64) for d, (n, total) in sums.items()}
    grams = _gram(vectors, grid, lambda x: (x - floors[x.shape[1]]).astype(np.float64))
    bases = {d: _basis(n, total, floors[d], grams[d], components)
             for d, (n, total) in sums.items()}

    def with_one(x: np.ndarray) -> np.ndarray:
        white = np.nan_to_num(bases[x.shape[1]].whitened(x), nan=0.0)
        return np.hstack([white, np.ones((len(x), 1))])

    for d, total in _gram(vectors, grid, with_one).items():
        basis = bases[d]
        mean = total[-1, :-1] / basis.rows
        covariance = total[:-1, :-1] / basis.rows - np.outer(mean, mean)
        wanted = np.diag((basis.eigenvalues > 0).astype(float))
        basis.identity_error = float(np.abs(covariance - wanted).max(initial=0.0))
    return bases


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           components: int = 32, grid: Grid = Grid()) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) per vector and component.

    Vectors that are null, empty or hold a null, a non-finite entry or one beyond the
    grid (2^52 steps) are left out. Vectors of each length are a list of their own
    with a basis of its own; a covariance has length² numbers, so lengths
    of a few thousand are meant. A component without spread (as many rows as
    dimensions, constant dimensions) has a null ``whitened`` and explains 0.
    ``deviation`` is null where a long can't hold it. Rows with equal or null ids
    stay rows of their own; other columns are not looked at. An empty table gives no rows.
    """
    bases = fit(df, vector_col, components, grid)
    fields = [StructField("component", IntegerType()), StructField("n", LongType()),
              StructField("deviation", LongType()), StructField("whitened", DoubleType()),
              StructField("explained", DoubleType()), StructField("identity_error", DoubleType())]
    rows = df.select(F.col(f"`{id_col}`").alias("id"),
                     F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    schema = StructType([rows.schema["id"], *fields])

    def run(batches):
        for batch in batches:
            for at, x in _by_length(batch.column("v"), grid):
                basis = bases[x.shape[1]]
                k = len(basis.eigenvalues)
                white = basis.whitened(x).ravel()
                ids = batch.column("id").take(pa.array(np.repeat(at, k)))
                columns = [
                    ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                    pa.array(np.full(len(at) * k, basis.rows)),
                    pa.array(basis.deviations(x), pa.int64()).take(
                        pa.array(np.repeat(np.arange(len(at)), k))),
                    pa.array(white, mask=np.isnan(white)),
                    pa.array(np.tile(basis.explained, len(at))),
                    pa.array(np.full(len(at) * k, basis.identity_error))]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
