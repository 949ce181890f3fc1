"""Language-model scores by a weighted backoff automaton of smoothed n-grams."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType


from gatewatch.llm.common import free_names, release_kept
from gatewatch.llm.packing import pack, pack_counts, range_slices, unpack, unpack_counts

# Text that one group of documents holds, about; each is counted in one task.
BLOCK_BYTES = 10 << 20
# Numbers of the two tokens that no word can be: the start and the end of a text.
START, END = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_MIX = np.uint64(0xFF51AFD7ED558CCD)


@dataclass(frozen=True)
class Settings:
    """A context seen n times weighs n against ``weight`` + ``share`` * n of the lower order."""
    weight: float = 10.0
    share: float = 1.5
    half: float = 0.5
    seed: int = 42
    text_col: str = "text"


def pair_numbers(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """64-bit numbers of word pairs from those of the words."""
    with np.errstate(over="ignore"):
        x = (left ^ (left >> np.uint64(33))) * _MIX + right
        x = (x ^ (x >> np.uint64(32))) * _MIX
        return x ^ (x >> np.uint64(29))


class Block:
    """The tokens of a group of texts as numbers, one text after the other."""

    def __init__(self, texts: list[str | None], seed: int):
        numbers: dict[bytes, int] = {}
        parts, lengths = [], []
        for text in texts:
            words = (text or "").encode().lower().split()
            for w in set(words):
                if w not in numbers:
                    numbers[w] = xxhash.xxh64_intdigest(w, seed)
            part = np.empty(len(words) + 1, np.uint64)
            part[:-1] = np.fromiter(map(numbers.__getitem__, words), np.uint64, len(words))
            part[-1] = END
            parts.append(part)
            lengths.append(len(part))
        self.lengths = np.array(lengths, np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.tokens = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        before = np.roll(self.tokens, 1)
        if len(parts):
            before[self.starts] = START
        # Each distinct context and word once; a text's start is a context too.
        self.words, self.word_at = np.unique(self.tokens, return_inverse=True)
        self.pairs, self.pair_at = np.unique(pair_numbers(before, self.tokens),
                                             return_inverse=True)
        self.before = before

    def totals(self, teaches: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often each word and pair occurs in the texts that teach."""
        use = np.repeat(teaches, self.lengths)
        return (np.bincount(self.word_at[use], minlength=len(self.words)),
                np.bincount(self.pair_at[use], minlength=len(self.pairs)))


class BackoffAutomaton:
    """States are the contexts of one word and, below them, the empty context.

    A seen pair is an arc of its context's state with the smoothed
    log-probability; a state without the arc fails to the empty context at the
    price of its failure weight, where every word has an arc. The probability
    given a context h is (c(hw) + k * p(w)) / (c(h) + k) with k = weight + share * c(h)
    and p(w) = (c(w) + half) / (N + half * (V + 1)); they add up to 1 over the V
    known words and one for all others.
    """

    def __init__(self, word_counts, context_counts, pair_counts, total: int, distinct: int,
                 settings: Settings):
        """Counts are those of each token, of its context and of the pair of both."""
        s = settings
        lower = (word_counts + s.half) / (total + s.half * (distinct + 1))
        self.root = np.log10(lower)
        below = s.weight + s.share * context_counts
        self.arc = np.log10((pair_counts + below * lower) / (context_counts + below))
        self.has_arc = pair_counts > 0
        self.failure = np.log10(below / (context_counts + below))

    def traverse(self) -> np.ndarray:
        """Weights along the way: an arc, or the failure arc and then the root's arc."""
        return np.where(self.has_arc, self.arc, self.failure + self.root)


REQUEST = "block int, bucket int, words binary, word_n binary, pairs binary, pair_n binary"
REPLY = ("block int, bucket int, word_n binary, pair_n binary, total bigint, distinct bigint, "
         "starts bigint")


def _request(rows: pa.Table, block_col: str, teaches_col: str, buckets: int,
             settings: Settings) -> pa.Table:
    """What a block asks and teaches, one row for each range of numbers."""
    release_kept()
    block = Block(rows[settings.text_col].to_pylist(), settings.seed)
    teaches = rows[teaches_col].to_numpy().astype(bool)
    word_n, pair_n = block.totals(teaches)
    name = rows[block_col][0].as_py()
    out = []
    starts = int(teaches.sum())
    parts = zip(range_slices(block.words, buckets), range_slices(block.pairs, buckets))
    for b, (w, p) in enumerate(parts):
        out.append((name, b, pack(block.words[w]), pack_counts(word_n[w]), pack(block.pairs[p]),
                    pack_counts(pair_n[p])))
    # The start of a text is a context, though never a token.
    cols = list(zip(*out))
    table = pa.table([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()),
                      *(pa.array(c, pa.binary()) for c in cols[2:])],
                     names=["block", "bucket", "words", "word_n", "pairs", "pair_n"])
    return table.append_column("starts", pa.array([starts if b == 0 else 0
                                                   for b in range(buckets)], pa.int64()))


def _reply(rows: pa.Table) -> pa.Table:
    """Adds up the counts of one range over all blocks and answers each block."""
    found = {}
    for numbers, counts in (("words", "word_n"), ("pairs", "pair_n")):
        keys = [unpack(x) for x in rows[numbers].to_pylist()]
        values = [unpack_counts(x) for x in rows[counts].to_pylist()]
        distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(at, np.concatenate(values), len(distinct)).astype(np.int64)
        ends = np.cumsum([len(k) for k in keys])[:-1]
        found[counts] = [pack_counts(total[part]) for part in np.split(at, ends)]
        if counts == "word_n":
            tokens, kinds = int(total.sum()), int((total > 0).sum())
    n = rows.num_rows
    starts = sum(rows["starts"].to_pylist())
    return pa.table([rows["block"], rows["bucket"], pa.array(found["word_n"], pa.binary()),
                     pa.array(found["pair_n"], pa.binary()), pa.array([tokens] * n, pa.int64()),
                     pa.array([kinds] * n, pa.int64()), pa.array([starts] * n, pa.int64())],
                    names=["block", "bucket", "word_n", "pair_n", "total", "distinct", "starts"])


def _scored(rows: pa.Table, replies: pa.Table, kept: list[str], settings: Settings) -> pa.Table:
    replies = replies.sort_by("bucket")
    block = Block(rows[settings.text_col].to_pylist(), settings.seed)
    word_n, pair_n = (np.concatenate([unpack_counts(x) for x in replies[c].to_pylist()])
                      for c in ("word_n", "pair_n"))
    total, distinct, starts = (sum(replies[c].to_pylist())
                               for c in ("total", "distinct", "starts"))
    words = word_n[block.word_at]
    contexts = np.roll(words, 1)
    contexts[block.starts] = starts
    automaton = BackoffAutomaton(words, contexts, pair_n[block.pair_at], total, distinct,
                                 settings)

    def per_text(values):
        return np.add.reduceat(values, block.starts)
    return pa.table([*(rows[c] for c in kept),
                     pa.array(block.lengths), pa.array(per_text((words > 0).astype(np.int64))),
                     pa.array(np.full(rows.num_rows, total, np.int64)),
                     pa.array(per_text(automaton.root)), pa.array(per_text(automaton.traverse()))],
                    names=[*kept, "n_tokens", "n_known", "train_tokens", "base_score", "score"])


def score_texts(df: DataFrame, teaches: Column, settings: Settings = Settings(),
                block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``df`` without its texts, with n_tokens, n_known, train_tokens, base_score, score.

    The model learns from all rows for which ``teaches`` holds. Documents are
    dealt to blocks of about ``block_bytes`` by a digest of the row. A block's
    distinct words and pairs, 64-bit numbers with counts, go in ranges of
    numbers to the tasks that add them up; each answers every block with the
    totals of just what that block asked. So no task holds a vocabulary beyond
    its range or its block, and a frequent word is one number per block. The
    block's part of the automaton then scores its texts from left to right. The rows
    between blocks and ranges grow with the square of the text over ``block_bytes``:
    on executors with more memory, larger blocks are the better choice.

    Words are known by XXH64: among a thousand million distinct words two share
    a number with a chance of about 3 %. Null texts count as empty, an empty
    text is its end alone. Repeated rows count and come out each. Columns named
    like a result are replaced; an empty table gives an empty one.
    """
    new = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    kept = [c for c in df.columns if c.lower() not in new and c != settings.text_col]
    spark, text = df.sparkSession, F.col(f"`{settings.text_col}`")
    size = df.agg(F.sum(F.coalesce(F.octet_length(text), F.lit(0)))).first()[0]
    blocks = max((size or 0) // block_bytes + 1,
                 int(spark.conf.get("spark.sql.shuffle.partitions")))
    name, learns = free_names(df, "_block", "_teaches")
    rows = df.select(
        *(F.col(f"`{c}`") for c in kept), text,
        F.coalesce(teaches, F.lit(False)).alias(learns),
        F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in kept), text), F.lit(blocks))
        .cast("int").alias(name))
    replies = (rows.groupBy(name)
               .applyInArrow(lambda t: _request(t, name, learns, blocks, settings),
                             f"{REQUEST}, starts bigint")
               .groupBy("bucket").applyInArrow(_reply, REPLY))
    schema = StructType([df.schema[c] for c in kept] + [
        StructField("n_tokens", LongType()), StructField("n_known", LongType()),
        StructField("train_tokens", LongType()), StructField("base_score", DoubleType()),
        StructField("score", DoubleType())])
    return rows.groupBy(name).cogroup(replies.groupBy("block")).applyInArrow(
        lambda t, r: _scored(t, r, kept, settings), schema)
