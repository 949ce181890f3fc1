"""Importance resampling towards a target: hashed word weights, ranks by a radix sort."""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from gatewatch.llm.common import annotate, release_kept, slices
from gatewatch.llm.components import cut_lineage

# What parts words is all ASCII but digits and letters.
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall
CACHE_WORDS = 1 << 18
DIGIT_BITS = 11
# Rows that one task orders: at least the first, more where there would be over the
# second number of parts.
PART_ROWS, MAX_PARTS = 1 << 14, 1 << 14


@dataclass(frozen=True)
class Settings:
    buckets: int = 10_000
    grams: int = 1          # features are runs of 1 to this many words
    least_words: int = 20   # documents with fewer are never drawn
    percent: int = 10
    seed: int = 2024


class Features:
    """Bucket numbers of a text's features, with a bounded cache of words."""

    def __init__(self, settings: Settings):
        self.settings, self.cache = settings, {}

    def words(self, text: str) -> list[str]:
        return _WORDS(text.translate(_LOWER))

    def buckets(self, words: list[str]) -> np.ndarray:
        """Bucket of each run of words, repeats included."""
        cache, buckets = self.cache, self.settings.buckets
        found = []
        for n in range(1, self.settings.grams + 1):
            runs = words if n == 1 else [" ".join(words[k:k + n])
                                         for k in range(len(words) - n + 1)]
            for w in set(runs).difference(cache):
                cache[w] = zlib.crc32(w.encode()) % buckets
            found.extend(map(cache.__getitem__, runs))
            if len(cache) > CACHE_WORDS:
                cache.clear()
        return np.array(found, np.int64)


def bucket_counts(df: DataFrame, text_col: str, settings: Settings) -> np.ndarray:
    """How many features of all whole texts fall into each bucket.

    Each task counts its texts in one array; ``settings.buckets`` sums reach the driver.
    """
    def count(batches):
        release_kept()
        features = Features(settings)
        total = np.zeros(settings.buckets, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                for text in part.column("text").to_pylist():
                    if text:
                        total += np.bincount(features.buckets(features.words(text)),
                                             minlength=settings.buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["k", "n"])

    sums = (df.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(count, "k long, n long")
            .groupBy("k").agg(F.sum("n").alias("n")).toArrow())
    out = np.zeros(settings.buckets, np.int64)
    out[sums["k"].to_numpy()] = sums["n"].to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of target to source share, per bucket, floors taken."""
    size, all_s, all_t = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(1000.0 * math.log(
        (t + 1.0) * (all_s + size) / ((s + 1.0) * (all_t + size))))
        for s, t in zip(source.tolist(), target.tolist())], np.int64)


def noise(id_col: str, seed: int) -> Column:
    """Gumbel noise in thousandths from the digest of the id; a null id is empty text."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def add_weights(df: DataFrame, text_col: str, gain: np.ndarray, settings: Settings) -> DataFrame:
    """``df`` with n_words, n_features and weight of each whole text.

    The gains of a text's features are taken from one array and added up.
    Columns named like a result are replaced.
    """
    fields = [StructField(n, LongType()) for n in ("n_words", "n_features", "weight")]

    def make():
        features = Features(settings)

        def weigh(texts):
            out = []
            for text in texts:
                words = features.words(text)
                numbers = features.buckets(words)
                out.append((len(words), len(numbers), int(gain[numbers].sum())))
            return [list(column) for column in zip(*out)] if out else [[], [], []]
        return weigh

    return annotate(df, text_col, fields, make)


def _move(place: str, part: str, digit: str):
    """Places of a part's rows after a pass: its counting sort by the digit, stable."""
    def run(rows: pa.Table, starts: pa.Table) -> pa.Table:
        at = rows.column(place).to_numpy()
        before = np.argsort(at, kind="stable")
        digits = rows.column(digit).to_numpy().astype(np.uint16)
        order = before[np.argsort(digits[before], kind="stable")]
        ordered = digits[order]
        start = np.zeros(1 << DIGIT_BITS, np.int64)
        start[starts.column("digit").to_numpy()] = starts.column("first").to_numpy()
        new = np.empty(len(at), np.int64)
        new[order] = (start[ordered] + np.arange(len(at))
                      - np.searchsorted(ordered, ordered))
        return (rows.drop_columns([place, part, digit])
                .append_column(place, pa.array(new)))
    return run


def ranked(rows: DataFrame, keys: list[tuple[str, int]], part_rows: int | None = None,
           out: str = "rank") -> DataFrame:
    """``rows`` with their place (from 1) in the order of whole-number columns.

    ``keys`` names columns of numbers from 0 on and their bits, the most significant
    first. A radix sort from the least digit of the last key up: rows lie in
    parts; in each pass the parts count their digits, prefix sums over digits and
    parts give the first place of each digit of each part, and every row moves to a
    place behind its equals of its own and earlier parts, so the order of equal digits
    stays. After a pass all parts have the same number of rows, whatever
    the keys are. Each pass goes to the shared checkpoint folder. Rows with equal
    keys keep the order of the first checkpoint. ``out`` replaces a column of that name.
    """
    names = [c for c in rows.columns if c.lower() != out.lower()]
    taken = {n.lower() for n in names}
    place, part, digit = (_unused(n, taken) for n in ("place", "part", "digit"))
    rows = cut_lineage(rows.select(*(F.col(f"`{c}`") for c in names),
                                   F.monotonically_increasing_id().alias(place)))
    if part_rows is None:
        part_rows = max(PART_ROWS, -(-rows.count() // MAX_PARTS))
    # The partitions of the checkpoint are the first parts.
    part_of = F.shiftright(F.col(place), 33)
    passes = [(column, shift) for column, bits in reversed(keys)
              for shift in range(0, bits, DIGIT_BITS)]
    for column, shift in passes or [(None, 0)]:
        value = (F.shiftright(F.col(f"`{column}`"), shift).bitwiseAND((1 << DIGIT_BITS) - 1)
                 if column else F.lit(0))
        here = rows.withColumns({part: part_of, digit: value.cast("int")})
        counts = here.groupBy(part, digit).agg(F.count("*").alias("n"))
        # At most 2048 digits, and at most one row per part for each of them.
        digits = counts.groupBy(digit).agg(F.sum("n").alias("all"))
        digits = digits.select(digit, (F.sum("all").over(W.orderBy(digit))
                                       - F.col("all")).alias("base"))
        inside = F.sum("n").over(W.partitionBy(digit).orderBy(part)) - F.col("n")
        starts = (counts.withColumn("inside", inside).join(digits, digit)
                  .select(F.col(part).alias("of"), F.col(digit).alias("digit"),
                          (F.col("base") + F.col("inside")).alias("first")))
        schema = here.drop(place, digit, part).withColumn(place, F.lit(0).cast("long")).schema
        rows = cut_lineage(
            here.groupBy(part).cogroup(starts.groupBy("of"))
            .applyInArrow(_move(place, part, digit), schema))
        part_of = F.floor(F.col(place) / part_rows).cast("long")
    return rows.select(*(F.col(f"`{c}`") for c in names), (F.col(place) + 1).alias(out))


def _unused(name: str, taken: set[str]) -> str:
    while name in taken:
        name += "_"
    taken.add(name)
    return name


def _bits(span: int | None) -> int:
    return int(span or 0).bit_length()


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """(id, n_features, weight, score, rank) for every row of ``docs``.

    ``weight`` adds up, over a text's hashed words (and word runs), by how much
    more frequent their bucket is in ``target``; ``score`` adds Gumbel noise made of the
    id, so the highest scores are a sample without replacement in proportion to the
    weights. Of the texts with ``least_words`` words or more, ``percent`` per cent
    (rounded down) are drawn: ``rank`` is 1, 2, 3 ... by falling score, ties by
    rising id (null first, as id and noise of an empty one), null for all others. Equal
    rows have places of their own. Null and empty texts have no features, weight 0 and are
    never drawn; an empty target is all zeros; ids are whole numbers. Other columns
    are not looked at: join the ranks to them by id, as ``drawn`` does.
    """
    counted = [bucket_counts(df, column, settings)
               for df, column in ((docs, text_col), (target, target_text_col))]
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    rows = cut_lineage(add_weights(rows, "text", gains(*counted), settings).drop("text")
                       .withColumn("score", F.col("weight") + noise("id", settings.seed)))
    fit = F.col("n_words") >= settings.least_words
    high = F.shiftright(F.col("id").cast("long"), 32)
    low = F.col("id").cast("long").bitwiseAND((1 << 32) - 1)
    ends = rows.where(fit).agg(
        F.count("*").alias("n"), F.max("score").alias("best"), F.min("score").alias("worst"),
        F.min(high).alias("first"), F.max(high).alias("last"), F.max(low).alias("low")).first()
    if not ends.n:
        return _result(rows.withColumn("rank", F.lit(None).cast("long")), id_col)
    # High halves of ids from 1 on; 0 is a null id. Scores count down from the best one.
    keyed = rows.where(fit).withColumns({
        "k_score": F.lit(ends.best) - F.col("score"),
        "k_high": F.coalesce(high - F.lit(ends["first"] or 0) + 1, F.lit(0)),
        "k_low": F.coalesce(low, F.lit(0))})
    span = (ends["last"] or 0) - (ends["first"] or 0) + 1
    order = ranked(keyed, [("k_score", _bits(ends.best - ends.worst)), ("k_high", _bits(span)),
                           ("k_low", _bits(ends.low))])
    take = settings.percent * ends.n // 100
    order = order.withColumn("rank", F.when(F.col("rank") <= take, F.col("rank")))
    rest = rows.where(~fit).withColumn("rank", F.lit(None).cast("long"))
    return _result(order.select(*rest.columns).unionByName(rest), id_col)


def _result(rows: DataFrame, id_col: str) -> DataFrame:
    return rows.select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank")


def drawn(docs: DataFrame, ranks: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose id was drawn, with all their columns and no others."""
    ids = ranks.where(F.col("rank").isNotNull()).select(F.col(f"`{id_col}`").alias(id_col))
    return docs.join(ids.distinct(), docs[f"`{id_col}`"].eqNullSafe(ids[id_col]), "left_semi")
