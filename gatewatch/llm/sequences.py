"""Best-fit packing of documents into sequences by a grouping genetic algorithm."""

from __future__ import annotations

import array
import json
import math
import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, IntegerType, LongType, StructField,
                               StructType)

from gatewatch.llm.common import arrow_type, kept_in_worker, slices
from gatewatch.llm.components import cut_lineage

CACHE_WORDS, CACHE_LENGTH = 3 << 19, 64
LIST_WORDS = 50
BYTE_0 = chr(256)
_PLAIN = re.compile(r"[!-&(-;=-~]+").fullmatch
# Letters that have one letter in lower case, and signs behind them, if any: there the
# library always cuts, and joins nothing over the cut.
_STEM = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:;=-@\[-`{-~]*)").fullmatch
# Digits alone, and runs of what is neither letter nor digit.
_CUTS = re.compile(r"[0-9]|[!-/:-@\[-`{-~]+").sub


@dataclass(frozen=True)
class Settings:
    capacity: int = 2048
    block: int = 4096       # pieces that one population packs
    islands: int = 4
    population: int = 6     # packings per island
    epochs: int = 3         # the best packing of an island moves on after each
    generations: int = 12   # children per epoch
    share: float = 0.1      # bins that a child takes whole from its first parent
    release: int = 2        # least filled bins of a block that are packed again with others'
    seed: int = 17


# ---- documents to pieces ---------------------------------------------------------------


class Encoder:
    """Ids of whole texts as the tokenizer at ``path`` gives them, word by word.

    White space parts the tokens of this tokenizer and is no token itself, so texts can be
    cut at spaces and line feeds and each distinct word be encoded once. The library gets
    new words in lists, with a token between them that none of them holds. Plain words
    (printable ASCII without apostrophes) go to it lower-cased and split already, which saves
    its normaliser and its splitting pattern; all others as they are. Of a word of
    Latin letters and signs behind them, the letters in lower case and the signs are looked up for
    themselves, so other cases and signs of a known word do not go to the library.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        spec |= {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}}
        self.bare = Tokenizer.from_str(json.dumps(spec))
        self.cache: dict[str, bytes] = {}
        # Byte 0 and the letter that stands for it in byte-level vocabularies.
        self.between = self._ids("\0")
        probe = "a  b\nc"
        if (len(self.between) != 1 or self._ids(f"\0 {probe}") != self.between + [
                i for w in "abc" for i in self._ids(w)]
                or self.bare.encode(BYTE_0, add_special_tokens=False).ids != self.between
                or self._ids("Ab1,-2.") != [i for w in ("ab", "1", ",-", "2", ".")
                                            for i in self._ids(w)]):
            raise ValueError(f"{path} does not split words as this encoder does")

    def _ids(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def encoded(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, little-endian with 32 bits each."""
        cache = self.cache
        if len(cache) > CACHE_WORDS:
            for w in list(islice(cache, CACHE_WORDS // 2)):
                del cache[w]
        words = [t.replace("\n", " ").split(" ") for t in texts]
        new: set[str] = set()
        for ws in words:
            new.update(set(ws).difference(cache))
        plain, odd, special, derived = set(), set(), [], []
        for w in new:
            found = _STEM(w)
            if found:
                stem, signs = found[1].lower(), found[2]
                for x in (stem, signs) if signs else (stem,):
                    if x not in cache:
                        (plain if x.isascii() else odd).add(x)
                if stem != w:
                    derived.append((w, stem, signs))
            elif _PLAIN(w):
                plain.add(w)
            elif "\0" in w or "<|" in w:
                special.append(w)
            else:
                odd.add(w)
        self._learn(list(plain), self.bare, lambda part: _CUTS(
            r" \g<0> ", " \0 ".join(part).lower()).replace("\0", BYTE_0))
        self._learn(list(odd), self.library, " \0 ".join)
        for w in special:
            cache[w] = _binary(self._ids(w))
        for w, stem, signs in derived:
            cache[w] = cache[stem] + cache[signs] if signs else cache[stem]
        out = [b"".join(map(cache.__getitem__, ws)) for ws in words]
        for w in [w for w in new.union(plain, odd) if len(w) > CACHE_LENGTH]:
            del cache[w]
        return out

    def _learn(self, words: list[str], tokenizer, joined) -> None:
        parts = [words[k:k + LIST_WORDS] for k in range(0, len(words), LIST_WORDS)]
        for lists in (parts[k:k + 100] for k in range(0, len(parts), 100)):
            for part, found in zip(lists, tokenizer.encode_batch_fast(
                    [joined(part) for part in lists], add_special_tokens=False)):
                data = _binary(found.ids)
                at = np.flatnonzero(np.frombuffer(data, "<u4") == self.between[0]) * 4
                starts, ends = [0, *(at + 4).tolist()], [*at.tolist(), len(data)]
                self.cache.update(zip(part, [data[a:b] for a, b in zip(starts, ends)],
                                      strict=True))


def _binary(ids: list[int]) -> bytes:
    numbers = array.array("I", ids)
    return numbers.tobytes() if numbers.itemsize == 4 else np.array(ids, "<u4").tobytes()


def cut_documents(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0,
                  id_col: str = "doc_id", text_col: str = "text",
                  ids: str | None = None) -> DataFrame:
    """(id, piece, start, length, ids_crc32 and, if named, a list ``ids``) per piece of a document.

    A document is the ids of its whole text and ``end_id``; one of more than
    ``capacity`` ids is cut into pieces of that length, of which the last may be shorter.
    A null text counts as empty: one piece, the end id alone. Rows with null or equal
    ids are documents of their own; other columns are not looked at. A task holds
    about 2 MB of text at a time, or one text if that is longer.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    fields = [StructField("piece", IntegerType()), StructField("start", LongType()),
              StructField("length", LongType()), StructField("ids_crc32", LongType())]
    if ids:
        fields.append(StructField(ids, ArrayType(LongType())))
    schema = StructType([rows.schema["id"], *fields])
    id_kind = arrow_type(rows.schema["id"].dataType)
    end, width = _binary([end_id]), 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_in_worker(("words", path), lambda: Encoder(path))
        for batch in batches:
            for part in slices(batch, "text"):
                texts = [x or "" for x in part.column("text").to_pylist()]
                found = []
                for doc, data in zip(part.column("id").to_pylist(), encoder.encoded(texts)):
                    data += end
                    for k, at in enumerate(range(0, len(data), width)):
                        piece = data[at:at + width]
                        found.append((doc, k, at // 4, len(piece) // 4, zlib.crc32(piece), piece))
                columns = [list(c) for c in zip(*found)] or [[]] * 6
                arrays = [pa.array(columns[0], id_kind), pa.array(columns[1], pa.int32()),
                          *(pa.array(c, pa.int64()) for c in columns[2:5])]
                if ids:
                    arrays.append(pa.array([np.frombuffer(p, "<u4").astype(np.int64)
                                            for p in columns[5]], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


# ---- packing of one block --------------------------------------------------------------


def best_fit(lengths: np.ndarray, items: np.ndarray, bins: np.ndarray, free: list[int],
             capacity: int) -> None:
    """Put ``items``, in their order, where the least space is left; fills ``bins`` and ``free``.

    The bins of each free space are a stack, and one whole number has a bit for each
    space that some bin has, so the tightest bin is its lowest bit from the length up.
    """
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    spaces = 0
    for b, space in enumerate(free):
        if space:
            stacks[space].append(b)
            spaces |= 1 << space
    for item, n in zip(items.tolist(), lengths[items].tolist()):
        above = spaces >> n
        if above:
            space = n + (above & -above).bit_length() - 1
            stack = stacks[space]
            b = stack.pop()
            if not stack:
                spaces ^= 1 << space
        else:
            b, space = len(free), capacity
            free.append(capacity)
        space -= n
        free[b] = space
        bins[item] = b
        if space:
            stacks[space].append(b)
            spaces |= 1 << space


def fills(lengths: np.ndarray, bins: np.ndarray) -> np.ndarray:
    return np.bincount(bins, lengths).astype(np.int64)


def fitness(lengths: np.ndarray, bins: np.ndarray, capacity: int) -> float:
    """Mean square of how full the bins are: few bins, and of those some very full ones."""
    full = fills(lengths, bins) / capacity
    return float((full * full).mean())


def least_bins(lengths: np.ndarray, capacity: int) -> int:
    """No packing takes fewer: by sum, and by what can't share a bin with a large piece."""
    values, counts = np.unique(lengths, return_counts=True)
    number, weight = np.cumsum(counts), np.cumsum(values * counts)

    def up_to(limit: int, sums: np.ndarray) -> int:
        k = np.searchsorted(values, limit, "right")
        return int(sums[k - 1]) if k else 0

    total, best = int(weight[-1]), -(-int(weight[-1]) // capacity)
    for small in [0, *values[values <= capacity // 2].tolist()]:
        alone = len(lengths) - up_to(capacity - small, number) if small else 0
        half = len(lengths) - up_to(capacity // 2, number) - alone
        held = up_to(capacity - small, weight) if small else total
        middle = held - up_to(capacity // 2, weight)
        rest = up_to(capacity // 2, weight) - up_to(small - 1, weight)
        more = max(0, rest - (half * capacity - middle))
        best = max(best, alone + half - (-more // capacity))
    return best


def _compact(bins: np.ndarray) -> np.ndarray:
    return np.unique(bins, return_inverse=True)[1]


def _rebuilt(lengths: np.ndarray, bins: np.ndarray, gone: np.ndarray, capacity: int) -> np.ndarray:
    """The packing after the bins marked ``gone`` were emptied and their pieces best-fitted."""
    loose = np.flatnonzero(gone[bins])
    name = np.cumsum(~gone) - 1
    out = name[bins]
    out[loose] = 0
    free = (capacity - fills(lengths, bins)[~gone]).tolist()
    best_fit(lengths, loose, out, free, capacity)
    return out


def crossover(lengths: np.ndarray, one: np.ndarray, two: np.ndarray, share: float, capacity: int,
              rng: np.random.Generator) -> np.ndarray:
    """``two`` with some of the best filled bins of ``one`` whole.

    Bins of ``two`` that hold a piece of an injected bin go; their other pieces
    are displaced, and best-fitted, longest first, into what stays.
    """
    full = fills(lengths, one)
    take = max(1, int(len(full) * share))
    # Well filled ones with preference: each draws a number below its fill.
    chosen = np.argsort(-(full / capacity) ** 8 * rng.random(len(full)), kind="stable")[:take]
    injected = np.zeros(len(full), bool)
    injected[chosen] = True
    inside = injected[one]
    gone = np.zeros(int(two.max()) + 1, bool)
    gone[two[inside]] = True
    loose = np.flatnonzero(gone[two] & ~inside)
    name = np.cumsum(~gone) - 1
    kept = int((~gone).sum())
    out = name[two]
    fresh = np.cumsum(injected) - 1 + kept
    out[inside] = fresh[one[inside]]
    free = [*(capacity - fills(lengths, two)[~gone]).tolist(),
            *(capacity - full[injected]).tolist()]
    out[loose] = 0
    best_fit(lengths, loose, out, free, capacity)
    return out


def mutated(lengths: np.ndarray, bins: np.ndarray, capacity: int,
            rng: np.random.Generator) -> np.ndarray:
    """Without its least filled bin and a few others, whose pieces are best-fitted again."""
    full = fills(lengths, bins)
    gone = np.zeros(len(full), bool)
    gone[full.argmin()] = True
    gone[rng.integers(0, len(full), max(1, len(full) // 50))] = True
    return _rebuilt(lengths, bins, gone, capacity)


def first_packings(lengths: np.ndarray, settings: Settings,
                   rng: np.random.Generator) -> list[np.ndarray]:
    """Best fit by falling length, and of the same with lengths blurred more and more.

    The first one alone where no packing can be better.
    """
    out, bound = [], least_bins(lengths, settings.capacity)
    for k in range(settings.population):
        blur = 1 + rng.random(len(lengths)) * 0.3 * k / settings.population
        bins = np.zeros(len(lengths), np.int64)
        best_fit(lengths, np.argsort(-lengths * blur, kind="stable"), bins, [], settings.capacity)
        out.append(bins)
        if k == 0 and int(bins.max()) + 1 <= bound:
            break
    return out


def evolved(lengths: np.ndarray, packings: list[np.ndarray], settings: Settings,
            rng: np.random.Generator) -> list[np.ndarray]:
    """An island's packings, best first, after an epoch; it ends where no packing can be better."""
    capacity, bound = settings.capacity, least_bins(lengths, settings.capacity)
    ranked = sorted(((fitness(lengths, p, capacity), k, p) for k, p in enumerate(packings)),
                    key=lambda x: (-x[0], x[1]))[:settings.population]
    serial = len(packings)
    for _ in range(settings.generations):
        if int(ranked[0][2].max()) + 1 <= bound:
            break
        a, b = (min(rng.integers(0, len(ranked), 2)) for _ in range(2))
        child = crossover(lengths, ranked[a][2], ranked[b][2], settings.share, capacity, rng)
        if rng.random() < 0.5:
            child = mutated(lengths, child, capacity, rng)
        serial += 1
        ranked.append((fitness(lengths, child, capacity), serial, child))
        ranked.sort(key=lambda x: (-x[0], x[1]))
        # A child that is as good as another takes no second place.
        scores = [r[0] for r in ranked]
        ranked = [r for k, r in enumerate(ranked) if k == 0 or scores[k] != scores[k - 1]]
        ranked = ranked[:settings.population]
    return [_compact(r[2]) for r in ranked]


# ---- islands ---------------------------------------------------------------------------


def _pack(arrays: list[np.ndarray]) -> bytes:
    flat = np.concatenate(arrays).astype("<i4") if arrays else np.zeros(0, "<i4")
    return zstandard.ZstdCompressor(level=1).compress(flat.tobytes())


def _unpack(data: bytes, size: int) -> list[np.ndarray]:
    flat = np.frombuffer(zstandard.decompress(data), "<i4").astype(np.int64)
    return list(flat.reshape(-1, size)) if size else []


ISLAND = StructType([StructField("block", LongType()), StructField("island", LongType()),
                     StructField("size", LongType()), StructField("lengths", BinaryType()),
                     StructField("packings", BinaryType())])


def _islands(pieces: DataFrame, settings: Settings) -> DataFrame:
    """One row per island of each block: the lengths, and its first packings."""
    blocks = pieces.groupBy("_block").agg(F.sort_array(F.collect_list(
        F.struct((-F.col("_length")).alias("n"), F.col("_row")))).alias("rows"))
    rows = blocks.select(F.col("_block").alias("block"), F.col("rows.n").alias("n"),
                         F.explode(F.sequence(F.lit(0), F.lit(settings.islands - 1))).alias(
                             "island"))
    # An island is one row from here on; they are dealt out before the work starts.
    rows = rows.repartition("block", "island")

    def run(batches):
        for batch in batches:
            for block, n, island in zip(*(batch.column(c).to_pylist()
                                          for c in ("block", "n", "island"))):
                lengths = -np.array(n, np.int64)
                rng = np.random.default_rng([settings.seed, block, island, 0])
                yield _island_row(block, island, lengths,
                                  evolved(lengths, first_packings(lengths, settings, rng),
                                          settings, rng))

    return rows.mapInArrow(run, ISLAND)


def _island_row(block: int, island: int, lengths: np.ndarray, packings) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{
        "block": block, "island": island, "size": len(lengths), "lengths": _pack([lengths]),
        "packings": _pack(packings)}], schema=pa.schema([
            ("block", pa.int64()), ("island", pa.int64()), ("size", pa.int64()),
            ("lengths", pa.binary()), ("packings", pa.binary())]))


def _migrated(islands: DataFrame, epoch: int, settings: Settings) -> DataFrame:
    """The best packing of each island joins the next one's, and all evolve further."""
    def best(batches):
        for batch in batches:
            for r in batch.to_pylist():
                first = _unpack(r["packings"], r["size"])[:1]
                yield _island_row(r["block"], (r["island"] + 1) % settings.islands,
                                  np.zeros(0, np.int64), first)

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                lengths = _unpack(r["lengths"], r["size"])[0]
                packings = _unpack(r["packings"], r["size"])
                packings += _unpack(r["guest"], r["size"])
                rng = np.random.default_rng([settings.seed, r["block"], r["island"], epoch])
                yield _island_row(r["block"], r["island"], lengths,
                                  evolved(lengths, packings, settings, rng))

    guests = (islands.select(*ISLAND.names).mapInArrow(best, ISLAND)
              .select("block", "island", F.col("packings").alias("guest")))
    return islands.join(guests, ["block", "island"]).mapInArrow(run, ISLAND)


def _best(islands: DataFrame, settings: Settings) -> DataFrame:
    """(block, size, lengths, packing): the best packing among the islands of each block."""
    def score(batches):
        for batch in batches:
            for r in batch.to_pylist():
                lengths = _unpack(r["lengths"], r["size"])[0]
                first = _unpack(r["packings"], r["size"])[0]
                yield pa.RecordBatch.from_pylist([{
                    "block": r["block"], "bins": int(first.max()) + 1, "island": r["island"],
                    "fit": fitness(lengths, first, settings.capacity), "packing": _pack([first])}])

    scored = islands.mapInArrow(
        score, "block long, bins long, island long, fit double, packing binary")
    return (scored.groupBy("block").agg(F.min(F.struct(
        "bins", (-F.col("fit")).alias("unfit"), "island", "packing")).alias("best"))
        .select("block", "best.packing"))


def _placed(pieces: DataFrame, best: DataFrame, settings: Settings, level: int,
            last: bool) -> DataFrame:
    """Pieces with sequence and offset; those of released bins have none."""
    schema = StructType([*pieces.schema.fields, StructField("_sequence", LongType()),
                         StructField("_offset", LongType())])

    def run(rows: pa.Table, found: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        order = np.lexsort((rows.column("_row").to_numpy(), -rows.column("_length").to_numpy()))
        rows = rows.take(pa.array(order))
        lengths = rows.column("_length").to_numpy()
        bins = _unpack(found.column("packing")[0].as_py(), len(lengths))[0]
        by_bin = np.argsort(bins, kind="stable")
        ends = np.cumsum(lengths[by_bin])
        starts = ends - lengths[by_bin]
        first = np.searchsorted(bins[by_bin], bins[by_bin])
        offset = np.empty(len(bins), np.int64)
        offset[by_bin] = starts - starts[first]
        full = fills(lengths, bins)
        out = np.zeros(len(full), bool)
        if not last:
            out[np.argsort(full, kind="stable")[:settings.release]] = True
            out &= full < settings.capacity
        # Level, block and bin in one number: a block has no more bins than pieces.
        block = rows.column("_block")[0].as_py() if len(rows) else 0
        names = ((block << 8 | level) << 24) + bins
        return (rows.append_column("_sequence", pa.array(names, mask=out[bins]))
                .append_column("_offset", pa.array(offset, mask=out[bins])))

    return (pieces.groupBy("_block").cogroup(best.groupBy("block")).applyInArrow(run, schema))


def pack(pieces: DataFrame, length_col: str = "length",
         settings: Settings = Settings()) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset`` in sequences of at most ``capacity``.

    Pieces are dealt evenly to blocks, whatever their values. Each block is packed by
    several islands at once: an island holds packings, makes children by injecting well
    filled bins of one packing whole into another one, removing what is there twice and
    best-fitting what that displaced, and hands its best packing to the next island
    after each epoch. Each block's best packing counts; the least filled bins
    of the blocks are opened and packed again together, level by level, until
    one block is left. Rounds go to the shared checkpoint folder; seeds are made
    of block, island and epoch, so a repeated task gives the same. Lengths have to lie
    between 1 and ``capacity``. Equal rows are pieces of their own; columns named
    ``sequence_id`` or ``offset`` are replaced; an empty table stays empty.
    """
    kept = [c for c in pieces.columns if c.lower() not in ("sequence_id", "offset")]
    rows = cut_lineage(pieces.select(
        F.struct(*(F.col(f"`{c}`") for c in kept)).alias("_piece"),
        F.col(f"`{length_col}`").cast("long").alias("_length"),
        F.monotonically_increasing_id().alias("_row")))
    done, level, count, before = [], 0, rows.count(), math.inf
    while True:
        blocks = max(1, -(-count // settings.block))
        # Where bins hold so many pieces that opening them leaves over half, that is the end.
        last = blocks == 1 or count > before / 2
        # Rows lie one behind the other in a partition, so taking turns deals evenly.
        dealt = rows.withColumn("_block", F.pmod(
            F.shiftright("_row", 33) + F.col("_row").bitwiseAND((1 << 33) - 1), F.lit(blocks)))
        islands = cut_lineage(_islands(dealt, settings))
        for epoch in range(1, settings.epochs):
            islands = cut_lineage(_migrated(islands, epoch, settings))
        placed = cut_lineage(_placed(dealt, _best(islands, settings), settings, level, last))
        done.append(placed.where(F.col("_sequence").isNotNull()))
        if last:
            break
        rows = placed.where(F.col("_sequence").isNull()).select("_piece", "_length", "_row")
        rows = cut_lineage(rows.withColumn("_row", F.monotonically_increasing_id()))
        before, count, level = count, rows.count(), level + 1
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.select(*(F.col("_piece")[c].alias(c) for c in kept),
                      F.col("_sequence").alias("sequence_id"), F.col("_offset").alias("offset"))


def sequences(packed: DataFrame, ids: str = "ids") -> DataFrame:
    """(sequence_id, ids): the packed pieces' lists of ids behind one another."""
    parts = F.sort_array(F.collect_list(F.struct("offset", F.col(f"`{ids}`").alias("ids"))))
    return packed.groupBy("sequence_id").agg(F.flatten(parts["ids"]).alias(ids))
