"""Lag over a key of which single values may hold a large part of all rows.

A window partitioned by the key alone puts all rows of one key value in one
task. Here the rows of every value are cut into time slots first. Inside a slot the
lag is an ordinary window; only the first rows of a slot need rows of earlier
slots, and those are found among the slot edges, of which there are at most
``2 * offset`` per slot, however many rows a slot holds.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SLOT_SECONDS = 60
# What rules and durations need: a lag per key, ``lag_by_key`` or that of a stream.
Lag = Callable[..., DataFrame]


def lag_by_key(df: DataFrame, key: str, order: Sequence[str], lags: dict[str, str],
               offset: int = 1, slot_seconds: int = SLOT_SECONDS) -> DataFrame:
    """Add ``lags`` (new column -> source column), ``offset`` rows back per key.

    ``order[0]`` is the event time; ``order`` has to be unique per key for a
    repeatable result. Two windows follow each other: one per key and slot over
    all rows, then one per key over the edges of the slots. Rows that are no edge
    pass the second window in groups of their own.
    """
    in_slot = W.partitionBy(key, "_slot").orderBy(*order)
    slotted = (df.withColumn("_slot", F.floor(F.unix_seconds(order[0]) / slot_seconds))
               .withColumns({f"_in_{new}": F.lag(old, offset).over(in_slot)
                             for new, old in lags.items()})
               .withColumns({"_n": F.row_number().over(in_slot),
                             "_ahead": F.lead(F.lit(1), offset).over(in_slot)}))
    # First rows by their number; last rows have nothing ``offset`` rows ahead.
    edge = (F.col("_n") <= offset) | F.col("_ahead").isNull()
    edges = W.partitionBy(key, "_inner_slot", "_inner").orderBy(*order)
    return (slotted
            .withColumns({"_inner_slot": F.when(~edge, F.col("_slot")),
                          "_inner": F.when(~edge, F.col("_n"))})
            .withColumns({f"_out_{new}": F.lag(old, offset).over(edges)
                          for new, old in lags.items()})
            .select(*df.columns,
                    *[F.when(F.col("_n") <= offset, F.col(f"_out_{new}"))
                      .otherwise(F.col(f"_in_{new}")).alias(new) for new in lags]))
