"""Repeated substrings across documents: anchors bring them together, suffix sorting finds them.

Every window of ``width`` bytes is represented by its anchor, the place of the
smallest digest of ``gram`` bytes in it (the leftmost of equal ones). Equal
windows have equal anchors, so windows meet by the digest of their anchor. The
consecutive windows of one anchor form a piece of text; a piece that occurs
again as a whole needs no sorting. All other pieces that share an anchor are
suffix-sorted together.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from gatewatch.llm.common import arrow_type, free_names, release_kept
from gatewatch.llm.packing import pack, pack_counts, range_slices, unpack, unpack_counts

# Text that one block of documents holds, about.
BLOCK_BYTES = 8 << 20
# Text that is looked at in one go for anchors, and that is sorted in one go.
PART_BYTES = 1 << 18
SORT_BYTES = 1 << 18
# Different pieces under one anchor that are sorted together; where there are
# more, their windows meet one by one.
CROWD = 1000

_PLACE = np.uint64((1 << 24) - 1)
_HALF = np.uint64((1 << 32) - 1)
_RNG = np.random.default_rng(20)
# Two independent digests: a factor and a number for each byte.
_FACTORS = [0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93]
_BYTES = _RNG.integers(1 << 63, size=(2, 256), dtype=np.int64).view(np.uint64)


@dataclass(frozen=True)
class Settings:
    width: int = 100
    gram: int = 24
    id_col: str = "doc_id"
    text_col: str = "text"


def _powers(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Powers and inverse powers of both factors, up to n."""
    out = []
    for f in _FACTORS:
        pair = []
        for x in (f, pow(f, -1, 1 << 64)):
            p = np.full(n + 1, np.uint64(x))
            p[0] = 1
            pair.append(np.cumprod(p, dtype=np.uint64))
        out.append(tuple(pair))
    return out


def _stirred(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


class Digests:
    """Digests of any stretch of a text."""

    def __init__(self, data: np.ndarray, powers):
        self.inverse = [p[1] for p in powers]
        self.sums = []
        for (power, _), numbers in zip(powers, _BYTES):
            s = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(numbers[data] * power[:len(data)], out=s[1:])
            self.sums.append(s)

    def of(self, start: np.ndarray, end: np.ndarray, which: int) -> np.ndarray:
        s = self.sums[which]
        return _stirred((s[end] - s[start]) * self.inverse[which][start]
                        + (end - start).astype(np.uint64))


def _sliding_least(keys: np.ndarray, n: int) -> np.ndarray:
    """Least of each n consecutive keys."""
    size = 1
    while size * 2 <= n:
        keys = np.minimum(keys[:len(keys) - size], keys[size:])
        size *= 2
    rest = n - size
    return np.minimum(keys[:len(keys) - rest], keys[rest:]) if rest else keys


@dataclass
class Pieces:
    """The pieces of a block: anchor digest, both content digests, first window, windows."""
    anchor: np.ndarray
    content: np.ndarray
    check: np.ndarray
    place: np.ndarray
    windows: np.ndarray


class Block:
    """Different documents of a group of rows, in the order of (id, text), one text."""

    def __init__(self, ids: list[int | None], texts: list[str | None], settings: Settings):
        self.settings = settings
        rows = [(-(1 << 63) if i is None else i, (t or "").encode()) for i, t in zip(ids, texts)]
        documents = sorted(set(rows))
        index = {d: k for k, d in enumerate(documents)}
        self.row_document = [index[r] for r in rows]
        self.ids = np.array([d[0] for d in documents], np.int64)
        self.lengths = np.array([len(d[1]) for d in documents], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(d[1] for d in documents), np.uint8)

    def ids_at(self, places: np.ndarray) -> np.ndarray:
        return self.ids[np.searchsorted(self.starts, places, "right") - 1]

    def parts(self):
        """(start, end) of stretches of text; long documents overlap by a window less one."""
        width, first = self.settings.width, None
        limit = min(PART_BYTES, 1 << 23)
        for start, n in zip(self.starts.tolist(), self.lengths.tolist()):
            if n >= limit:
                if first is not None:
                    yield first, start
                    first = None
                for at in range(start, start + n - width + 1, limit):
                    yield at, min(start + n, at + limit + width - 1)
            elif first is None:
                first = start
            elif start + n - first > limit:
                yield first, start
                first = start
        if first is not None:
            yield first, len(self.data)

    def pieces(self) -> Pieces:
        """All pieces, sorted by anchor, content and place."""
        s, found = self.settings, []
        powers = _powers(min(len(self.data), PART_BYTES + s.width))
        ends = self.starts + self.lengths
        for a, b in self.parts():
            if b - a < s.width:
                continue
            if b - a >= len(powers[0][0]):
                powers = _powers(b - a)
            digests = Digests(self.data[a:b], powers)
            at = np.arange(b - a - s.gram + 1)
            gram = digests.of(at, at + s.gram, 0)
            keys = (gram & ~_PLACE) | at.astype(np.uint64)
            least = (_sliding_least(keys, s.width - s.gram + 1) & _PLACE).astype(np.int64)
            # Windows that lie in one document.
            window = np.arange(len(least))
            document = np.searchsorted(self.starts, window + a, "right") - 1
            inside = window + a + s.width <= ends[document]
            window, least, document = window[inside], least[inside], document[inside]
            if not len(window):
                continue
            new = np.concatenate(([True], (np.diff(least) != 0) | (np.diff(document) != 0)))
            first = np.flatnonzero(new)
            count = np.diff(first, append=len(window))
            start = window[first]
            # Least digests are small numbers; stirred again they fill the ranges evenly.
            found.append((_stirred(gram[least[first]] + np.uint64(1)),
                          digests.of(start, start + count + s.width - 1, 1),
                          digests.of(start, start + count + s.width - 1, 0) & _HALF,
                          start + a, count))
        columns = [np.concatenate(x) for x in zip(*found)] if found else [
            np.zeros(0, t) for t in (np.uint64, np.uint64, np.uint64, np.int64, np.int64)]
        order = np.lexsort(columns[3::-1])
        return Pieces(*(c[order] for c in columns))


def _firsts(*keys: np.ndarray) -> np.ndarray:
    """Whether a row of sorted keys differs from the one before."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return new


def _spans(start: np.ndarray, end: np.ndarray) -> bytes:
    """Joined spans, packed."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order]) if len(end) else end
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > end[:-1]
    last = np.append(np.flatnonzero(new)[1:] - 1, len(start) - 1) if len(start) else []
    return pack_counts(np.concatenate((start[new], end[last] if len(start) else end)))


def _unspans(data: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    halves = [unpack_counts(d).reshape(2, -1) for d in data]
    both = np.concatenate(halves, axis=1) if halves else np.zeros((2, 0), np.int64)
    return both[0], both[1]


ASK = ("block int, bucket int, anchor binary, content binary, check binary, id binary, "
       "place binary")
CODES = "block int, bucket int, codes binary"
SEND = ("kind int, bucket int, block int, a binary, b binary, id binary, place binary, "
        "windows binary, text binary")
FOUND = "block int, spans binary"
# What becomes of a block's first piece with some anchor and content.
ALONE, REPEATED, SORT, CROWDED = range(4)
# Kinds of rows after that: spans that are known, pieces to sort, single windows.
SPANS, PIECES, WINDOWS = range(3)


def _block(rows: pa.Table, settings: Settings) -> Block:
    release_kept()
    return Block(rows[settings.id_col].to_pylist(), rows[settings.text_col].to_pylist(), settings)


def _ask(rows: pa.Table, column: str, buckets: int, settings: Settings) -> pa.Table:
    """The different pieces of a block, a row for each range of anchors."""
    block = _block(rows, settings)
    pieces, name = block.pieces(), rows[column][0].as_py()
    first = _firsts(pieces.anchor, pieces.content, pieces.check)
    anchor, content, check, place = (x[first] for x in (
        pieces.anchor, pieces.content, pieces.check, pieces.place))
    ids = block.ids_at(place) if len(place) else place
    out = [(name, b, pack(anchor[r]), pack_counts(content[r]), pack_counts(check[r]),
            pack_counts(ids[r]), pack_counts(place[r])) for b, r in enumerate(range_slices(anchor, buckets))]
    return _table(out, ASK)


_KINDS = {"int": pa.int32(), "binary": pa.binary()}


def _table(rows: list[tuple], schema: str) -> pa.Table:
    names, kinds = zip(*(x.split() for x in schema.split(", ")))
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.table([pa.array(c, _KINDS[k]) for c, k in zip(columns, kinds)], names=list(names))


def _gathered(rows: pa.Table, ascending: str, *others: str):
    """Packed columns of several rows behind one another, and each record's row."""
    first = [unpack(x) for x in rows[ascending].to_pylist()]
    lengths = [len(x) for x in first]
    rest = [np.concatenate([unpack_counts(x) for x in rows[c].to_pylist()]) for c in others]
    return np.concatenate(first), rest, np.repeat(np.arange(len(lengths)), lengths), lengths


def _codes(rows: pa.Table, crowd: int) -> pa.Table:
    """For each piece: whether an earlier equal one exists, and what else its anchor has."""
    anchor, (content, check, ids, place), row, lengths = _gathered(
        rows, "anchor", "content", "check", "id", "place")
    block = rows["block"].to_numpy()[row]
    order = np.lexsort((place, block, ids, check, content, anchor))
    first = _firsts(anchor[order], content[order], check[order])
    group = np.cumsum(_firsts(anchor[order])) - 1
    contents = np.bincount(group, first, group[-1] + 1 if len(group) else 0)[group]
    code = np.where(~first, REPEATED, np.where(contents < 2, ALONE,
                                               np.where(contents <= crowd, SORT, CROWDED)))
    codes = np.empty(len(order), np.uint8)
    codes[order] = code
    parts = np.split(codes, np.cumsum(lengths)[:-1])
    return pa.table([rows["block"], rows["bucket"],
                     pa.array([p.tobytes() for p in parts], pa.binary())],
                    names=["block", "bucket", "codes"])


def _send(rows: pa.Table, replies: pa.Table, column: str, buckets: int,
          settings: Settings) -> pa.Table:
    """Known spans, pieces to sort and windows to compare of a block."""
    if not rows.num_rows:
        return _table([], SEND)
    block, name = _block(rows, settings), rows[column][0].as_py()
    pieces, width = block.pieces(), settings.width
    first = _firsts(pieces.anchor, pieces.content, pieces.check)
    replies = replies.sort_by("bucket")
    codes = np.frombuffer(b"".join(replies["codes"].to_pylist()), np.uint8)
    code = np.full(len(first), REPEATED, np.uint8)
    code[first] = codes
    known = code == REPEATED
    out = [(SPANS, name % buckets, name, *[None] * 5, _spans(
        pieces.place[known], pieces.place[known] + pieces.windows[known] + width - 1))]

    chosen = np.flatnonzero(code == SORT)
    for b, r in enumerate(range_slices(pieces.anchor[chosen], buckets)):
        if r.stop > r.start:
            at = chosen[r]
            start, n = pieces.place[at], pieces.windows[at]
            text = b"".join(block.data[s:s + k + width - 1].tobytes()
                            for s, k in zip(start.tolist(), n.tolist()))
            out.append((PIECES, b, name, pack(pieces.anchor[at]), None,
                        pack_counts(block.ids_at(start)), pack_counts(start), pack_counts(n),
                        text))

    crowded = np.flatnonzero(code == CROWDED)
    if len(crowded):
        n = pieces.windows[crowded]
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        place = np.sort(np.repeat(pieces.place[crowded], n) + inside)
        a, b = _window_digests(block, place, width)
        order = np.lexsort((place, b, a))
        a, b, place = a[order], b[order], place[order]
        new = _firsts(a, b)
        out.append((SPANS, name % buckets, name, *[None] * 5,
                    _spans(place[~new], place[~new] + width)))
        a, b, place = a[new], b[new], place[new]
        for k, r in enumerate(range_slices(a, buckets)):
            if r.stop > r.start:
                out.append((WINDOWS, k, name, pack(a[r]), pack_counts(b[r]),
                            pack_counts(block.ids_at(place[r])), pack_counts(place[r]), None,
                            None))
    return _table(out, SEND)


def _window_digests(block: Block, places: np.ndarray, width: int):
    """Both digests of the windows at ascending places."""
    powers, out = _powers(PART_BYTES + width), []
    cuts = np.flatnonzero(np.diff(places // PART_BYTES)) + 1
    for part in np.split(places, cuts):
        low = int(part[0])
        digests = Digests(block.data[low:int(part[-1]) + width], powers)
        out.append([digests.of(part - low, part - low + width, k) for k in (0, 1)])
    return tuple(np.concatenate(x) for x in zip(*out))


def _find(rows: pa.Table, settings: Settings) -> pa.Table:
    """The repeated spans of one kind and range, for each block."""
    kind = rows["kind"][0].as_py()
    if kind == SPANS:
        return _table([(b, t) for b, t in zip(rows["block"].to_pylist(),
                                              rows["text"].to_pylist())], FOUND)
    if kind == WINDOWS:
        a, (b, ids, place), row, _ = _gathered(rows, "a", "b", "id", "place")
        block = rows["block"].to_numpy()[row]
        order = np.lexsort((place, block, ids, b, a))
        again = order[~_firsts(a[order], b[order])]
        return _by_block(block[again], place[again], settings.width)
    anchor, (ids, place, windows), row, _ = _gathered(rows, "a", "id", "place", "windows")
    block = rows["block"].to_numpy()[row]
    data = np.frombuffer(b"".join(rows["text"].to_pylist()), np.uint8)
    size = windows + settings.width - 1
    start = np.cumsum(size) - size
    order = np.argsort(anchor, kind="stable")
    group = np.flatnonzero(_firsts(anchor[order]))
    total = np.cumsum(size[order])
    blocks, places = [], []
    a = 0
    while a < len(order):
        # As many whole groups as fit; a group is never cut.
        b = np.searchsorted(total, total[a] - size[order[a]] + SORT_BYTES, "right")
        cut = group[np.searchsorted(group, b, "right") - 1] if b < len(order) else len(order)
        if cut <= a:
            nxt = group[group > a]
            cut = nxt[0] if len(nxt) else len(order)
        part = order[a:cut]
        owner, offset = _repeated(data, start[part], windows[part], ids[part], block[part],
                                  place[part], settings.width)
        blocks.append(block[part][owner])
        places.append(place[part][owner] + offset)
        a = cut
    return _by_block(np.concatenate(blocks), np.concatenate(places), settings.width)


def _by_block(block: np.ndarray, place: np.ndarray, width: int) -> pa.Table:
    order = np.argsort(block, kind="stable")
    names, at = np.unique(block[order], return_index=True)
    parts = np.split(place[order], at[1:]) if len(names) else []
    return _table([(int(b), _spans(p, p + width)) for b, p in zip(names, parts)], FOUND)


def _repeated(data, start, windows, ids, block, place, width):
    """(piece, offset) of each window that an earlier equal one of the pieces precedes."""
    size = windows + width - 1
    offset = np.cumsum(size) - size
    text = np.concatenate([data[s:s + n] for s, n in zip(start.tolist(), size.tolist())])
    suffixes = sort_suffixes(text, offset, size, windows, width)
    piece = np.searchsorted(offset, suffixes, "right") - 1
    inside = suffixes - offset[piece]
    chosen = inside < windows[piece]
    suffixes, piece, inside = suffixes[chosen], piece[chosen], inside[chosen]
    alike = common_prefix(text, suffixes, width)
    group = np.cumsum(np.concatenate(([True], ~alike)))[:len(suffixes)]
    order = np.lexsort((place[piece] + inside, block[piece], ids[piece], group))
    again = order[~_firsts(group[order])]
    return piece[again], inside[again]


def common_prefix(text: np.ndarray, suffixes: np.ndarray, width: int) -> np.ndarray:
    """Whether neighbouring suffixes have a common prefix of ``width`` bytes at least."""
    view = np.lib.stride_tricks.sliding_window_view(text, width)
    out = np.zeros(max(len(suffixes) - 1, 0), bool)
    for a in range(0, len(out), 1 << 16):
        rows = view[suffixes[a:a + (1 << 16) + 1]]
        out[a:a + (1 << 16)] = (rows[1:] == rows[:-1]).all(axis=1)
    return out


def sort_suffixes(text: np.ndarray, offset: np.ndarray, size: np.ndarray, windows: np.ndarray,
                  width: int) -> np.ndarray:
    """Suffixes of the pieces of a text in order of their first ``width`` bytes.

    Two stages: suffixes smaller than their successors are sorted directly. All
    others are induced by one scan over the buckets of the first byte: the
    suffix before a sorted one, if it is larger, takes the next place in its
    bucket. A bucket holds larger suffixes before smaller ones, so when
    the scan gets there, all of its larger suffixes are in place. Suffixes are those of
    the first ``windows`` places of each piece and, where the last of these is larger
    than its successor, those behind it up to one that is not.
    """
    n = len(text)
    last = np.zeros(n, bool)
    last[offset + size - 1] = True
    same = np.zeros(n, bool)
    same[:-1] = (text[1:] == text[:-1]) & ~last[:-1]
    smaller = last.copy()
    smaller[:-1] |= (text[:-1] < text[1:]) & ~last[:-1]
    # In a run of one byte, the last place decides for all.
    at = np.where(same, n, np.arange(n))
    smaller = smaller[np.minimum.accumulate(at[::-1])[::-1]]
    at = np.where(smaller, np.arange(n), n)
    until = np.minimum.accumulate(at[::-1])[::-1][offset + windows - 1]
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, offset, 1)
    np.add.at(edge, until + 1, -1)
    wanted = np.cumsum(edge[:n]) > 0

    direct = np.flatnonzero(wanted & smaller)
    raw, ends = text.tobytes(), np.repeat(offset + size, size)[direct].tolist()
    keys = [raw[s:min(s + width, e)] for s, e in zip(direct.tolist(), ends)]
    direct = direct[sorted(range(len(keys)), key=keys.__getitem__)]
    larger = wanted & ~smaller
    first = text[direct]
    cuts = np.searchsorted(first, np.arange(257))
    buckets: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []

    def induce(sorted_suffixes: np.ndarray) -> None:
        before = sorted_suffixes[sorted_suffixes > 0] - 1
        before = before[larger[before] & ~last[before]]
        heads = text[before]
        order = np.argsort(heads, kind="stable")
        values, at = np.unique(heads[order], return_index=True)
        for v, part in zip(values.tolist(), np.split(before[order], at[1:])):
            buckets[v].append(part)

    for v in range(256):
        done = 0
        while done < len(buckets[v]):  # a bucket may add to itself
            part = np.concatenate(buckets[v][done:])
            done = len(buckets[v])
            out.append(part)
            induce(part)
        part = direct[cuts[v]:cuts[v + 1]]
        out.append(part)
        induce(part)
    return np.concatenate(out)


SPAN = ArrayType(StructType([StructField("start", LongType()), StructField("end", LongType())]))


def _spans_of(rows: pa.Table, found: pa.Table, settings: Settings) -> list[list[dict]]:
    """The spans of each row's own text."""
    block = _block(rows, settings)
    start, end = _unspans(found["spans"].to_pylist())
    start, end = _unspans([_spans(start, end)])
    document = np.searchsorted(block.starts, start, "right") - 1
    # Spans of neighbouring documents may touch and then are one: cut them at the ends.
    spans: list[list] = [[] for _ in block.ids]
    ends = block.starts + block.lengths
    for s, e, d in zip(start.tolist(), end.tolist(), document.tolist()):
        while s < e:
            if ends[d] > s:
                stop = min(e, int(ends[d]))
                base = int(block.starts[d])
                spans[d].append({"start": s - base, "end": stop - base})
                s = stop
            d += 1
    return [spans[d] for d in block.row_document]


def _marked(rows: pa.Table, found: pa.Table, kept: list[str], settings: Settings) -> pa.Table:
    """Rows with their spans."""
    return pa.table([*(rows[c] for c in kept),
                     pa.array(_spans_of(rows, found, settings), arrow_type(SPAN))],
                    names=[*kept, "repeat_spans"])


def _without(rows: pa.Table, found: pa.Table, kept: list[str], settings: Settings) -> pa.Table:
    """Rows without the bytes of their spans."""
    texts = [_left(t, s) for t, s in zip(rows[settings.text_col].to_pylist(),
                                         _spans_of(rows, found, settings))]
    return pa.table([pa.array(texts, pa.string()) if c == settings.text_col else rows[c]
                     for c in kept], names=kept)


def _left(text: str | None, spans: list[dict]) -> str | None:
    """A text without its spans; a letter of which only some bytes remain goes too."""
    if not spans:
        return text
    return b"".join(kept_bytes(text.encode(), spans)).decode("utf-8", "ignore")


def find_repeats(df: DataFrame, settings: Settings = Settings(),
                 block_bytes: int = BLOCK_BYTES, crowd: int = CROWD) -> DataFrame:
    """``df`` with ``repeat_spans``: byte ranges covered by windows that also start earlier.

    Earlier is a smaller id, or the same document and an earlier start. A null
    id comes first. Rows that repeat an id with another text come in the order of a
    digest; rows that repeat id and text are one document, and each row gets its
    spans. Null and empty texts have none, nor have those shorter than a window.

    Documents are dealt to blocks of about ``block_bytes`` by a digest of id and
    text. A block sends its different pieces as digests (96 bits beside the
    anchor's) in ranges of anchors, gets back which of them repeat, and sends
    only pieces that differ under an anchor that others have. A task sorts
    pieces in portions of whole anchors. An anchor with over ``crowd`` pieces is not
    sorted in one task: its windows meet by digests of 128 bits, each in its own
    range. What a task holds is bounded by the block and the range; as the rows between
    them grow with the square of the text over ``block_bytes``, executors with more
    memory are better served by larger blocks.
    """
    kept = [c for c in df.columns if c.lower() != "repeat_spans"]
    schema = StructType([df.schema[c] for c in kept] + [StructField("repeat_spans", SPAN)])
    return _finished(df, kept, settings, block_bytes, crowd, _marked, schema)


def without_repeats(df: DataFrame, settings: Settings = Settings(),
                    block_bytes: int = BLOCK_BYTES, crowd: int = CROWD) -> DataFrame:
    """``df`` without the bytes that ``find_repeats`` marks.

    A letter of which only some bytes remain goes too. Texts that have no span
    stay as they are, null included; a text may become empty. All columns stay.
    """
    return _finished(df, df.columns, settings, block_bytes, crowd, _without, df.schema)


def _finished(df: DataFrame, kept: list[str], settings: Settings, block_bytes: int, crowd: int,
              finish, schema: StructType) -> DataFrame:
    spark = df.sparkSession
    ids, text = F.col(f"`{settings.id_col}`"), F.col(f"`{settings.text_col}`")
    size = df.agg(F.sum(F.coalesce(F.octet_length(text), F.lit(0)))).first()[0]
    blocks = max((size or 0) // block_bytes + 1,
                 int(spark.conf.get("spark.sql.shuffle.partitions")))
    # One exchange of the rows serves all three passes.
    name, = free_names(df, "_block")
    rows = df.select(*(F.col(f"`{c}`") for c in kept),
                     F.pmod(F.xxhash64(ids, text), F.lit(blocks)).cast("int").alias(name))
    codes = (rows.groupBy(name)
             .applyInArrow(lambda t: _ask(t, name, blocks, settings), ASK)
             .groupBy("bucket").applyInArrow(lambda t: _codes(t, crowd), CODES))
    sent = rows.groupBy(name).cogroup(codes.groupBy("block")).applyInArrow(
        lambda t, r: _send(t, r, name, blocks, settings), SEND)
    found = sent.groupBy("kind", "bucket").applyInArrow(lambda t: _find(t, settings), FOUND)
    return rows.groupBy(name).cogroup(found.groupBy("block")).applyInArrow(
        lambda t, r: finish(t, r, kept, settings), schema)


def report(repeats: DataFrame, text_col: str = "text") -> DataFrame:
    """``n_bytes``, ``n_removed``, ``n_spans`` and the digest of the remaining bytes."""
    fields = [StructField("n_bytes", LongType()), StructField("n_removed", LongType()),
              StructField("n_spans", LongType()), StructField("kept_sha256", StringType())]
    kept = [c for c in repeats.columns
            if c not in ("repeat_spans", "n_bytes", "n_removed", "n_spans", "kept_sha256")]
    schema = StructType([repeats.schema[c] for c in kept] + fields)

    def run(batches):
        for batch in batches:
            out = []
            for text, spans in zip(batch.column(text_col).to_pylist(),
                                   batch.column("repeat_spans").to_pylist()):
                data = (text or "").encode()
                left = kept_bytes(data, spans or [])
                out.append((len(data), len(data) - sum(map(len, left)), len(spans or []),
                            hashlib.sha256(b"".join(left)).hexdigest()))
            columns = list(zip(*out)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept),
                 *(pa.array(c, arrow_type(f.dataType)) for c, f in zip(columns, fields))],
                names=[*kept, *(f.name for f in fields)])

    return repeats.mapInArrow(run, schema)


def kept_bytes(data: bytes, spans: list[dict]) -> list[bytes]:
    out, at = [], 0
    for s in spans:
        out.append(data[at:s["start"]])
        at = s["end"]
    out.append(data[at:])
    return out
