"""Nearest neighbours by inner product: p-stable hashing with multiple probes."""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gatewatch.llm.components import cut_lineage


@dataclass(frozen=True)
class Settings:
    """``coarse`` of the ``functions`` of a table choose the task, the others the bucket
    in it; ``chunk_rows`` bounds the queries of a task, and ``member_chunks`` times as many its
    members: each task hands on the best of each of its queries, so few large chunks of members
    mean few rows per query, however many members there are. ``width``, ``functions`` and ``coarse``
    are chosen from the data where they are None. Lengths within a range differ by at
    most the factor ``ratio``. What the hash finds with less chance than ``recall`` is compared
    directly; ``aim`` is the share of near vectors that a chosen width has to visit."""
    tables: int = 4
    functions: int | None = None
    coarse: int | None = None
    width: float | None = None
    probes: int = 64
    chunk_rows: int = 4096
    member_chunks: int = 16
    cell_chunks: int = 64
    ratio: float = 1.5
    recall: float = 0.9
    aim: float = 0.95
    sample_rows: int = 4096
    sample_queries: int = 32
    seed: int = 5


# What is tried: few functions with narrow intervals up to many with wide ones.
FUNCTIONS = (4, 6, 8, 10, 12, 16)
WIDTHS = (0.25, 0.4, 0.6, 0.9, 1.2, 1.5, 2.0, 3.0)


def hashes(settings: Settings, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Directions (tables x dim x functions) from the 2-stable law, and shifts."""
    rng = np.random.default_rng(settings.seed)
    return (rng.normal(size=(settings.tables, dim, settings.functions)),
            rng.uniform(0, settings.width, (settings.tables, settings.functions)))


def probe_sets(depths: np.ndarray, width: float, probes: int) -> list[list[tuple[int, int]]]:
    """Perturbations in the order of their estimated success, the empty one first.

    ``depths`` are the distances to the lower bounds of the query's bucket. A
    set moves some functions to a neighbouring interval; it scores the sum of
    the squared distances to the bounds that it crosses. Sets come from a heap by
    moving the last step of a set on or adding the next one.
    """
    steps = sorted([(d * d, i, -1) for i, d in enumerate(depths)]
                   + [((width - d) ** 2, i, 1) for i, d in enumerate(depths)])
    out: list[list[tuple[int, int]]] = [[]]
    heap = [(steps[0][0], (0,))] if steps else []
    while heap and len(out) < probes:
        total, chosen = heapq.heappop(heap)
        functions = [steps[k][1] for k in chosen]
        if len(set(functions)) == len(functions):
            out.append([steps[k][1:] for k in chosen])
        last = chosen[-1]
        if last + 1 < len(steps):
            more = steps[last + 1][0]
            heapq.heappush(heap, (total + more, (*chosen, last + 1)))
            heapq.heappush(heap, (total - steps[last][0] + more, (*chosen[:-1], last + 1)))
    return out


@lru_cache
def sure_cosine(settings: Settings) -> float:
    """The least cosine (up to 1) with a query at which the probes visit a lifted vector
    with a chance of ``recall``, estimated from draws of the 2-stable law.

    The chance depends on the distance only, and tables are independent.
    """
    rng = np.random.default_rng(settings.seed)
    n, cosines = settings.functions, 1 - np.linspace(2, 0, 101) ** 2 / 2
    places, draws = 3 ** np.arange(n), 128
    missed = np.ones((len(cosines), draws))
    for k in range(draws):
        depths = rng.uniform(0, settings.width, n)
        visited = np.array([places.sum() + sum(d * places[i] for i, d in moves)
                            for moves in probe_sets(depths, settings.width, settings.probes)])
        steps = rng.normal(size=(256, n))
        for c, cosine in enumerate(cosines):
            away = np.floor((depths + steps * np.sqrt(2 - 2 * cosine)) / settings.width)
            near = (np.abs(away) <= 1).all(axis=1)
            at = (np.clip(away, -1, 1) + 1).astype(int) @ places
            missed[c, k] = 1 - (near & np.isin(at, visited)).mean()
    sure = 1 - missed.mean(axis=1) ** settings.tables >= settings.recall
    below = np.flatnonzero(~sure)
    return float(cosines[min(below[-1] + 1, len(cosines) - 1)]) if len(below) else -1.0


def _vectors(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of an array of lists that are equally long and hold no null."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(column), len(flat) // max(1, len(column)))


def lifted(x: np.ndarray, top: np.ndarray | float) -> np.ndarray:
    """Vectors over the greatest length of their range, with what is missing to length 1."""
    x = x / (top if np.isscalar(top) else top[:, None])
    return np.hstack([x, np.sqrt(np.maximum(0, 1 - (x * x).sum(axis=1)))[:, None]])


def chosen(sample: np.ndarray, rows: int, neighbours: int, settings: Settings) -> Settings:
    """Settings with which the probes visit the fewest of the ``sample`` (lifted vectors) and
    still reach ``aim`` of what is near.

    Some vectors of the sample ask for the others. Near is what would be among the
    ``neighbours`` if all ``rows`` were there, the nearest one of the sample at least; the
    farther quarter of that has to be reached, and surely by nine of ten queries. Each pair of functions and width is tried as it would run. Where none
    reaches the aim, the one that finds most is taken. Two functions choose the task, and more
    where a cell would hold over ``cell_chunks`` chunks of a table: few cells mean few lists
    per query, many mean few copies of what meets in a cell.
    """
    asked = min(settings.sample_queries, len(sample))
    queries = sample[:asked].copy()
    queries[:, -1] = 0  # a query is not lifted; its length does not matter
    queries /= np.maximum(np.sqrt((queries * queries).sum(axis=1)), 1e-300)[:, None]
    products = queries @ sample.T
    products[np.arange(asked), np.arange(asked)] = -np.inf
    near = max(1, min(len(sample) - 1, round(neighbours * len(sample) / max(rows, 1))))
    best = np.argsort(-products, axis=1)[:, near - max(1, near // 4):near]
    tried = []
    for functions in FUNCTIONS if settings.functions is None else [settings.functions]:
        for width in WIDTHS if settings.width is None else [settings.width]:
            one = replace(settings, functions=functions, width=width)
            directions, shifts = hashes(one, sample.shape[1])
            seen = np.zeros(products.shape, bool)
            for t in range(settings.tables):
                cells = np.floor((sample @ directions[t] + shifts[t]) / width)
                codes = _mixed(cells)
                f = queries @ directions[t] + shifts[t]
                home = np.floor(f / width)
                for k in range(asked):
                    seen[k] |= np.isin(codes, _mixed(_probed(f[k], home[k], one)))
            found = float(np.take_along_axis(seen, best, axis=1).mean()) if len(sample) > 1 else 1.0
            tried.append((found, float(seen.mean()), functions, width))
    # The cosine that nine of ten queries have with the last of what is near them.
    last = np.take_along_axis(products, best[:, -1:], axis=1)
    reach = float(np.quantile(last, 0.1)) if len(sample) > 1 else -1.0
    good = sorted((x for x in tried if x[0] >= settings.aim), key=lambda x: x[1])
    _, _, functions, width = next(
        (x for x in good if sure_cosine(replace(settings, functions=x[2], width=x[3])) <= reach),
        good[0] if good else max(tried, key=lambda x: (x[0], -x[1])))
    # A function parts lifted vectors into about 1 + 2 / width intervals that hold most.
    parts = max(1.0, rows / (settings.chunk_rows * settings.cell_chunks))
    coarse = settings.coarse or min(functions, max(2, math.ceil(
        math.log(parts) / math.log(1 + 2 / width))))
    return replace(settings, functions=functions, width=width, coarse=coarse)


def _probed(f: np.ndarray, home: np.ndarray, settings: Settings) -> np.ndarray:
    """The intervals of each bucket that a query visits in one table."""
    sets = probe_sets(f - home * settings.width, settings.width, settings.probes)
    out = np.repeat(home[None], len(sets), axis=0)
    for row, moves in zip(out, sets):
        for i, d in moves:
            row[i] += d
    return out


def _mixed(cells: np.ndarray) -> np.ndarray:
    """One 64-bit number for the intervals of any number of functions."""
    out = np.zeros(len(cells), np.uint64)
    for column in cells.astype(np.int64).astype(np.uint64).T:
        out = (out ^ column) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out.view(np.int64)


def _index_rows(batches, settings, dim):
    """(table, cell, bucket) of each vector, lifted to the unit sphere of its range."""
    directions, shifts = hashes(settings, dim + 1)
    for batch in batches:
        if not batch.num_rows:
            continue
        x = lifted(_vectors(batch.column("vector")), batch.column("top").to_numpy())
        first = batch.column("part").to_numpy() * settings.tables
        for t in range(settings.tables):
            cells = np.floor((x @ directions[t] + shifts[t]) / settings.width)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("vector"),
                 pa.array((first + t).astype(np.int32)),
                 pa.array(_mixed(cells[:, :settings.coarse])),
                 pa.array(_mixed(cells[:, settings.coarse:]))],
                names=["id", "vector", "table", "cell", "bucket"])


def _probe_rows(batches, settings, dim, parts):
    """(table, cell, buckets) that each query visits in each range, its vector with it."""
    directions, shifts = hashes(settings, dim + 1)
    for batch in batches:
        if not batch.num_rows:
            continue
        q = _vectors(batch.column("vector"))
        unit = q / np.sqrt((q * q).sum(axis=1))[:, None]
        unit = np.hstack([unit, np.zeros((len(q), 1))])
        rows, tables, cells_out, buckets = [], [], [], []
        for t in range(settings.tables):
            f = unit @ directions[t] + shifts[t]
            home = np.floor(f / settings.width)
            for k in range(len(q)):
                visited = _probed(f[k], home[k], settings)
                cell = _mixed(visited[:, :settings.coarse])
                bucket = _mixed(visited[:, settings.coarse:])
                for c in np.unique(cell):
                    rows.append(k)
                    tables.append(t)
                    cells_out.append(int(c))
                    buckets.append(np.unique(bucket[cell == c]))
        rows, tables = pa.array(rows), np.array(tables, np.int32)
        for part in parts:
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(rows), batch.column("vector").take(rows),
                 pa.array(part * settings.tables + tables, pa.int32()),
                 pa.array(cells_out, pa.int64()), pa.array(buckets, pa.list_(pa.int64()))],
                names=["id", "vector", "table", "cell", "buckets"])


def _nearest(members: pa.Table, probes: pa.Table, keep: int) -> pa.Table:
    """The best ``keep`` of the visited members for each query of a task."""
    out_q, out_m, out_s = [], [], []
    if members.num_rows and probes.num_rows:
        x, ids = _vectors(members["vector"]), members["id"].to_numpy()
        names, bucket = np.unique(members["bucket"].to_numpy(), return_inverse=True)
        queries = probes["id"].to_numpy()
        step = max(1, (1 << 22) // len(x))
        for a in range(0, len(queries), step):
            part = probes.slice(a, step)
            q = _vectors(part["vector"])
            visit = np.zeros((len(q), len(names) + 1), bool)
            for k, wanted in enumerate(part["buckets"].to_pylist()):
                at = np.minimum(np.searchsorted(names, wanted), len(names) - 1)
                visit[k, at[names[at] == wanted]] = True
            scores = np.where(visit[:, bucket], q @ x.T, -np.inf)
            if len(x) > keep:
                best = np.argpartition(-scores, keep - 1, axis=1)[:, :keep]
            else:
                best = np.broadcast_to(np.arange(len(x)), (len(q), len(x)))
            found = np.isfinite(np.take_along_axis(scores, best, axis=1))
            row, col = np.nonzero(found)
            member = best[row, col]
            out_q.append(queries[a + row])
            out_m.append(ids[member])
            # Summed row by row, so that a pair has one score wherever it is met.
            out_s.append((q[row] * x[member]).sum(axis=1))
    flat = [np.concatenate(v) if v else np.zeros(0, t) for v, t in (
        (out_q, np.int64), (out_m, np.int64), (out_s, np.float64))]
    return pa.table(dict(zip(("query", "member", "score"), flat)))


def _chunked(rows: DataFrame, own: str, copies: DataFrame, other: str) -> DataFrame:
    """Rows with their own chunk, once for each chunk of the other side of their cell.

    Spark broadcasts the numbers of chunks where they are small and else splits hot cells.
    """
    return (rows.join(copies, ["table", "cell"])
            .withColumn(own, F.pmod(F.xxhash64("id"), F.col(f"n_{own}")).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"n_{other}") - 1)))
            .drop(f"n_{own}", f"n_{other}"))


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector: double array) of the rows that take part."""
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), vector.alias("vector"))
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return rows.where(F.col("id").isNotNull() & F.col("vector").isNotNull() & finite
                      & F.exists("vector", lambda v: v != 0))


def nearest(df: DataFrame, is_query: Column, neighbours: int = 20, id_col: str = "vec_id",
            vector_col: str = "embedding", settings: Settings = Settings()) -> DataFrame:
    """(query_id, rank, vec_id, score): the best found rows for each query row.

    ``is_query`` is a condition on the column ``id``. Nearness is the inner
    product in double precision, ties go to the smaller id, a row is never its
    own neighbour. Vectors that are null, zero or hold null or non-finite
    components take no part, nor do rows without an id; of rows that repeat an id, each
    counts. Vectors with other numbers of components are tables of their own.

    Equal vectors are searched once: a class stands for them, and as ties go to
    small ids, its ``neighbours`` + 1 smallest ids are all that any result can
    hold. Vectors are parted by length, and each range is lifted to a unit sphere by
    its own greatest length, where the largest inner product is the smallest distance.
    Width and number of functions are chosen for each number of components from a sample of
    ``sample_rows`` vectors (see ``chosen``); every vector is in the index. Index and probes
    meet in cells of the coarse functions; crowded cells are cut into chunks on both sides,
    and a task hands on only the best of each of its queries.

    The last score that a query found tells how surely the hash finds a vector of a range
    with such a score. Where that is less than ``recall``, and no length rules the
    range out, the query is compared with the whole range.
    """
    rows = usable(df, id_col, vector_col)
    keep = neighbours + 1
    order = Window.partitionBy("vector").orderBy("id")
    copies = rows.withColumn("place", F.row_number().over(order)).where(
        F.col("place") <= keep)
    classes = rows.groupBy("vector").agg(F.min("id").alias("id"),
                                         F.max(is_query).alias("asks"))
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, v: s + v * v))
    # Equal lengths may differ in their last bits, so length 1 is not at the edge of a range.
    sized = classes.withColumns({"dim": F.size("vector"), "norm": norm}).withColumn(
        "range", F.floor(F.log("norm") / F.log(F.lit(settings.ratio)) + 0.5))
    sized = cut_lineage(sized)
    ranges = (sized.groupBy("dim", "range").agg(F.count("*").alias("n"),
                                                F.max("norm").alias("top"))
              .orderBy("dim", "range").collect())
    if not ranges:
        return _expanded(rows, classes, copies, _none(df.sparkSession), is_query, neighbours)
    placed = sized.join(F.broadcast(df.sparkSession.createDataFrame(
        [(r["dim"], r["range"], k, r["top"]) for k, r in enumerate(ranges)],
        "dim int, range bigint, part int, top double")), ["dim", "range"])
    asking = placed.where("asks")

    index = probes = None
    sure = []
    for dim in sorted({r["dim"] for r in ranges}):
        own = [k for k, r in enumerate(ranges) if r["dim"] == dim]
        here = F.col("dim") == dim
        # A bounded sample, the same one whatever the partitions are.
        sample = placed.where(here).orderBy(F.xxhash64("id")).limit(settings.sample_rows)
        sample = sample.select("vector", "top").toArrow()
        fitted = chosen(lifted(_vectors(sample["vector"]), sample["top"].to_numpy()),
                        sum(ranges[k]["n"] for k in own), neighbours, settings)
        sure += [(k, dim, ranges[k]["top"], sure_cosine(fitted)) for k in own]
        rows_of = placed.where(here).select("id", "vector", "part", "top").mapInArrow(
            lambda b, dim=dim, s=fitted: _index_rows(b, s, dim),
            "id bigint, vector array<double>, table int, cell bigint, bucket bigint")
        asked = asking.where(here).select("id", "vector").mapInArrow(
            lambda b, dim=dim, own=own, s=fitted: _probe_rows(b, s, dim, own),
            "id bigint, vector array<double>, table int, cell bigint, buckets array<bigint>")
        index = rows_of if index is None else index.unionByName(rows_of)
        probes = asked if probes is None else probes.unionByName(asked)
    found = cut_lineage(_best(_search(index, probes, settings, keep), keep))
    last = found.where(F.col("place") == keep).select(F.col("query").alias("id"), "score")
    parts = df.sparkSession.createDataFrame(sure, "part int, dim int, top double, sure double")
    unsure = (asking.drop("part", "top").join(last, "id", "left")
              .join(F.broadcast(parts), "dim")
              .where(F.col("score").isNull() | (
                  F.col("score") < F.col("norm") * F.col("top") * F.col("sure"))))
    more = _search(_whole(placed, F.col("part")), _whole(unsure, F.col("part"), queries=True),
                   settings, keep)
    found = _best(found.drop("place").unionByName(more), keep)
    return _expanded(rows, classes, copies, found.drop("place"), is_query, neighbours)


def _none(spark) -> DataFrame:
    return spark.createDataFrame([], "query bigint, member bigint, score double")


def _whole(side: DataFrame, cell: Column, queries: bool = False) -> DataFrame:
    """Index or probe rows of a comparison without a hash: one bucket for each ``cell``."""
    bucket = F.lit(0).cast("long")
    # Named anew, as both sides of a cogroup may come from the same classes.
    return side.select(F.col("id").alias("id"), F.col("vector").alias("vector"),
                       F.lit(-1).alias("table"), cell.cast("long").alias("cell"),
                       F.array(bucket).alias("buckets") if queries else bucket.alias("bucket"))


def _search(index: DataFrame, probes: DataFrame, settings: Settings, keep: int) -> DataFrame:
    """(query, member, score): the best of each task for each of its queries."""
    def sizes(side: DataFrame, name: str, rows: int) -> DataFrame:
        return side.groupBy("table", "cell").agg(
            F.ceil(F.count("*") / rows).cast("int").alias(name))

    chunks = sizes(index, "n_i", settings.chunk_rows * settings.member_chunks).join(
        sizes(probes, "n_j", settings.chunk_rows), ["table", "cell"])
    where = ["table", "cell", "i", "j"]
    return (_chunked(index, "i", chunks, "j").groupBy(*where)
            .cogroup(_chunked(probes, "j", chunks, "i").groupBy(*where))
            .applyInArrow(lambda m, p: _nearest(m, p, keep),
                          "query bigint, member bigint, score double"))


def _best(found: DataFrame, keep: int) -> DataFrame:
    """The ``keep`` best members of each query, with their ``place``."""
    best = Window.partitionBy("query").orderBy(F.desc("score"), "member")
    return (found.groupBy("query", "member").agg(F.max("score").alias("score"))
            .withColumn("place", F.row_number().over(best)).where(F.col("place") <= keep))


def _expanded(rows, classes, copies, merged, is_query, neighbours) -> DataFrame:
    """From classes to rows: the members of each class found, for each query row."""
    keep = neighbours + 1
    named = classes.select("vector", F.col("id").alias("class"))
    members = copies.join(named, "vector").select("class", "id")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    lists = (merged.join(members, merged["member"] == members["class"])
             .withColumn("place", F.row_number().over(best)).where(F.col("place") <= keep)
             .groupBy("query").agg(F.array_sort(F.collect_list(
                 F.struct("place", "id", "score"))).alias("found")))
    asking = rows.where(is_query).join(named, "vector").select(F.col("id").alias("query_id"),
                                                               F.col("class").alias("query"))
    # Without the query's own row: once, as a repeated id is another row.
    own = F.array_position(F.transform("found", lambda f: f["id"]), F.col("query_id"))
    others = F.slice(F.filter("found", lambda f, k: k + 1 != F.col("own")), 1, neighbours)
    return (asking.join(lists, "query").withColumn("own", own)
            .select("query_id", F.posexplode(others).alias("rank", "f"))
            .select("query_id", (F.col("rank") + 1).cast("int").alias("rank"),
                    F.col("f.id").alias("vec_id"), F.col("f.score").alias("score")))
