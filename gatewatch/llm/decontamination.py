"""Benchmark decontamination with a generalised suffix automaton over words."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, LongType, StringType, StructField,
                               StructType)

from gatewatch.llm.common import annotate, arrow_type, free_names

# Item texts that one automaton may hold; more items go to further automata.
BLOCK_BYTES = 16 << 20

# Bytes of words stay, A-Z in lower case; all others part words.
_WORD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128
              else 32 for c in range(256))
_FIND = re.compile(rb"[0-9A-Za-z\x80-\xff]+").finditer


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_WORD).split(b" ")


class SuffixAutomaton:
    """All word sequences of the items, with the items of each full window.

    Words are numbered; a state is a number. ``window`` words in a row are a
    window, and an item of fewer words (not none) is one window by itself.
    """

    def __init__(self, items: Iterable[tuple[str, str]], window: int):
        self.window, self.numbers = window, {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[tuple[str, list[int]]] = []
        for item, text in items:
            words = [self.numbers.setdefault(w, len(self.numbers))
                     for w in words_of(text) if w]
            if words:
                ends.append((item, words))
                at = 0
                for w in words:
                    at = self._extend(at, w)
        found: list[set[str]] = [set() for _ in self.next]
        short: list[list[tuple[int, str]]] = [[] for _ in self.next]
        for item, words in ends:
            at = 0
            for w in words:
                at = self.next[at][w]
                up = at
                while self.length[up] >= window and item not in found[up]:
                    found[up].add(item)
                    up = self.link[up]
            if len(words) < window:
                while self.length[self.link[at]] >= len(words):
                    at = self.link[at]
                short[at].append((len(words), item))
        # For each state: the items of its last `window` words; the short items that end there.
        self.items: list[frozenset[str]] = [frozenset()] * len(self.next)
        self.short: list[list[tuple[int, str]]] = [[]] * len(self.next)
        for at in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            up = self.link[at]
            if self.length[at] >= window:
                self.items[at] = (self.items[up] if self.length[up] >= window
                                  else frozenset(found[at]))
            self.short[at] = self.short[up] + short[at] if short[at] else self.short[up]
        self.least = min((min(len(w), window) for _, w in ends), default=0)

    def _extend(self, last: int, word: int) -> int:
        """The state of the last state's longest sequence and one more word."""
        nexts, link, length = self.next, self.link, self.length
        if word in nexts[last]:
            q = nexts[last][word]
            return q if length[q] == length[last] + 1 else self._split(last, word, q)
        new = len(nexts)
        nexts.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and word not in nexts[p]:
            nexts[p][word] = new
            p = link[p]
        if p >= 0:
            q = nexts[p][word]
            link[new] = q if length[q] == length[p] + 1 else self._split(p, word, q)
        return new

    def _split(self, p: int, word: int, q: int) -> int:
        clone = len(self.next)
        self.next.append(dict(self.next[q]))
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def matches(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Ranges of words (start, end) inside occurring windows, and the items.

        One pass carries the longest match that ends at each word. Only runs of
        known words that are long enough for a window are walked.
        """
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        numbers = list(map(self.numbers.get, words))
        at, n = 0, len(numbers)
        for stop in [*(i for i, w in enumerate(numbers) if w is None), n]:
            if stop - at >= self.least > 0:
                self._walk(numbers, at, stop, spans, items)
            at = stop + 1
        return spans, items

    def _walk(self, numbers, start, stop, spans, items) -> None:
        nexts, link, length, window = self.next, self.link, self.length, self.window
        state = long = 0
        for i in range(start, stop):
            w = numbers[i]
            while state and w not in nexts[state]:
                state = link[state]
                long = length[state]
            state = nexts[state].get(w, 0)
            long = long + 1 if state else 0
            reach = 0
            if long >= window:
                reach = window
                items |= self.items[state]
            if self.short[state]:
                for n, item in self.short[state]:
                    if n <= long:
                        items.add(item)
                        reach = max(reach, n)
            if reach:
                first = i + 1 - reach
                while spans and first <= spans[-1][0]:
                    first = min(first, spans.pop()[0])
                if spans and first <= spans[-1][1]:
                    spans[-1] = (spans[-1][0], i + 1)
                else:
                    spans.append((first, i + 1))


def _blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[list]:
    """Items in blocks of bounded size, one block on the driver at a time."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"),
                             F.coalesce(text_col, F.lit("")).alias("text")).distinct()
    total = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n = total // BLOCK_BYTES + 1
    for k in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k)
        yield [(r.item if r.item is not None else "", r.text) for r in part.collect()]


SPAN = ArrayType(StructType([StructField("start", LongType()), StructField("end", LongType())]))


def find_matches(df: DataFrame, benchmark: DataFrame, window: int = 10, text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``df`` with ``n_words``, ``hit_spans`` (word ranges, apart and in order), ``items``.

    Items come to the tasks as broadcast automata of BLOCK_BYTES of item text
    each (the sum is counted first); a benchmark beyond that makes several
    passes inside the same tasks. Null texts have no words; null item ids count
    as the empty id; repeated items are one; an empty benchmark hits nothing.
    """
    matcher = _matcher(benchmark, window, item_col, item_text_col)

    def make():
        match = matcher()

        def work(texts):
            found = match(texts)
            return [[len(w) for w, _, _ in found], [_joined(s) for _, s, _ in found],
                    [sorted(i) for _, _, i in found]]
        return work

    return annotate(df, text_col, [StructField("n_words", LongType()),
                                   StructField("hit_spans", SPAN),
                                   StructField("items", ArrayType(StringType()))], make)


def _matcher(benchmark: DataFrame, window: int, item_col: str, text_col: str):
    """Makes, in a task, the function from texts to their words, hit ranges and items."""
    context = benchmark.sparkSession.sparkContext
    blocks = [context.broadcast(block) for block in _blocks(benchmark, item_col, text_col)]

    def matcher():
        single = SuffixAutomaton(blocks[0].value, window) if len(blocks) == 1 else None

        def match(texts):
            found = [([w for w in words_of(t) if w], [], set()) for t in texts]
            for block in blocks:
                automaton = single or SuffixAutomaton(block.value, window)
                for words, spans, items in found:
                    s, i = automaton.matches(words)
                    spans += s
                    items |= i
            return found
        return match
    return matcher


def _joined(spans: list[tuple[int, int]]) -> list[dict]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [{"start": a, "end": b} for a, b in out]


def report(matches: DataFrame, hidden: str = "items") -> DataFrame:
    """Counts and digests of ``find_matches`` rows: ``n_hit``, ``n_items``,
    ``items_sha256`` (item ids in text order, joined by commas), ``contaminated``."""
    hits = F.aggregate("hit_spans", F.lit(0).cast("long"),
                       lambda total, s: total + s["end"] - s["start"])
    return (matches.withColumn("n_hit", hits)
            .withColumn("n_items", F.size(hidden).cast("long"))
            .withColumn("items_sha256", F.sha2(F.array_join(F.array_sort(hidden), ","), 256))
            .withColumn("contaminated", F.col("n_hit") > 0)
            .drop("hit_spans", hidden))


def remove_matches(matches: DataFrame, text_col: str = "text", min_words: int = 10,
                   max_coverage: float = 0.5) -> DataFrame:
    """The documents without hit ranges of at least ``min_words`` words.

    A document whose hit words are more than ``max_coverage`` of all its words
    goes whole. Cuts run from the first letter of a range's first word to the
    last letter of its last; everything else of a text stays as it is, null too.
    """
    hits = F.aggregate("hit_spans", F.lit(0).cast("long"),
                       lambda total, s: total + s["end"] - s["start"])
    kept = matches.where(F.col("n_words").eqNullSafe(0)
                         | (hits <= F.col("n_words") * F.lit(max_coverage)))
    schema = kept.schema

    def run(batches):
        at, kind = schema.fieldNames().index(text_col), arrow_type(StringType())
        for batch in batches:
            texts = batch.column(text_col).to_pylist()
            for k, spans in enumerate(batch.column("hit_spans").to_pylist()):
                long = [s for s in spans or [] if s["end"] - s["start"] >= min_words]
                if long:
                    texts[k] = _cut(texts[k], long)
            yield batch.set_column(at, text_col, pa.array(texts, type=kind))

    return kept.mapInArrow(run, schema).drop("n_words", "hit_spans", "items")


def decontaminate(df: DataFrame, benchmark: DataFrame, window: int = 10, min_words: int = 10,
                  max_coverage: float = 0.5, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text") -> DataFrame:
    """``find_matches`` and ``remove_matches`` in one pass over the texts.

    All columns stay, whatever their names. A null or empty text stays as it is; an empty
    benchmark cuts nothing; repeated rows are cut alike.
    """
    matcher = _matcher(benchmark, window, item_col, item_text_col)

    def make():
        match = matcher()

        def work(texts):
            kept, left = [], []
            for text, (words, spans, _) in zip(texts, match(texts)):
                spans = _joined(spans)
                hits = sum(s["end"] - s["start"] for s in spans)
                long = [s for s in spans if s["end"] - s["start"] >= min_words]
                kept.append(not words or hits <= len(words) * max_coverage)
                left.append(_cut(text, long) if long and kept[-1] else text)
            return [kept, left]
        return work

    stays, rest = free_names(df, "_kept", "_left")
    found = annotate(df, text_col, [StructField(stays, BooleanType()),
                                    StructField(rest, StringType())], make)
    text = F.when(F.col(f"`{text_col}`").isNotNull(), F.col(rest)).alias(text_col)
    return found.where(F.col(stays)).select(*(text if c == text_col else F.col(f"`{c}`")
                                         for c in df.columns))


def _cut(text: str, spans: list[dict]) -> str:
    data = text.encode()
    places = [m.span() for m in _FIND(data)]
    out, at = [], 0
    for s in spans:
        out.append(data[at:places[s["start"]][0]])
        at = places[s["end"] - 1][1]
    return b"".join([*out, data[at:]]).decode()


def digest(items: Iterable[str]) -> str:
    """The ``items_sha256`` of a set of item ids, for checks by other means."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
