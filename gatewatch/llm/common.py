"""What the operators share: reading tables, adding columns batch by batch, folds."""

from __future__ import annotations

import sys
from collections.abc import Callable, Hashable, Iterator
from types import SimpleNamespace
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DataType, DoubleType, IntegerType, LongType,
                               StringType, StructField, StructType)

SLICE_BYTES = 1 << 21

_ARROW = {LongType: pa.int64(), IntegerType: pa.int32(), DoubleType: pa.float64(),
          StringType: pa.string(), BooleanType: pa.bool_()}


def arrow_type(kind: DataType) -> pa.DataType:
    """The Arrow type of the simple types, and of lists and structs of them."""
    if hasattr(kind, "elementType"):
        return pa.list_(arrow_type(kind.elementType))
    if isinstance(kind, StructType):
        return pa.struct([(f.name, arrow_type(f.dataType)) for f in kind.fields])
    if kind.typeName() == "binary":
        return pa.binary()
    return _ARROW[type(kind)]


def kept_in_worker(key: Hashable, build: Callable[[], Any]) -> Any:
    """What ``build`` makes, kept for the later tasks of the same Python worker.

    For models that are read from a file and bounded caches beside them; results
    may not depend on it. (Functions come by value, so a module's own globals
    are new in each task.) Only the last one is kept.
    """
    shared = sys.modules.setdefault("_gatewatch_kept", SimpleNamespace(found={}))
    if key not in shared.found:
        shared.found.clear()
        shared.found[key] = build()
    return shared.found[key]


def release_kept() -> None:
    """Forget what earlier tasks of this Python worker left behind."""
    if "_gatewatch_kept" in sys.modules:
        sys.modules["_gatewatch_kept"].found.clear()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(id_col: str, parts: int) -> Column:
    """crc32 of the id as text modulo ``parts``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % parts


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that no column of ``df`` has, upper or lower case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def slices(batch: pa.RecordBatch, text_col: str) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about SLICE_BYTES of text each, one row at least."""
    lengths = pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_pylist()
    start = size = 0
    for i, n in enumerate(lengths):
        if i > start and size + n > SLICE_BYTES:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if start < len(lengths):
        yield batch.slice(start)


def annotate(df: DataFrame, text_col: str, fields: list[StructField],
             make: Callable[[], Callable[[list[str]], list]], keeps: bool = False) -> DataFrame:
    """``df`` with columns computed from its texts, in bounded slices of Arrow batches.

    ``make`` runs once in each task and returns the function from texts to one
    list per field; ``keeps`` says that it uses ``kept_in_worker``. A null text counts as
    the empty one. Columns of ``df`` that are named like a field are replaced.
    """
    new = {f.name.lower() for f in fields}
    kept = [c for c in df.columns if c.lower() not in new]
    schema = StructType([df.schema[c] for c in kept] + list(fields))
    types = [arrow_type(f.dataType) for f in fields]
    passed = [*kept] if text_col in kept else [*kept, text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:
            release_kept()
        work = make()
        for batch in batches:
            for part in slices(batch, text_col):
                texts = [x or "" for x in part.column(text_col).to_pylist()]
                found = work(texts)
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in kept]
                    + [pa.array(v, type=t) for v, t in zip(found, types, strict=True)],
                    names=kept + [f.name for f in fields])

    return df.select(*(F.col(f"`{c}`") for c in passed)).mapInArrow(run, schema)
