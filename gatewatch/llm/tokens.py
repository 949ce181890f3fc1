"""Token counts of byte-level BPE by rank-synchronous merging of ragged arrays."""

from __future__ import annotations

import json

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField

from gatewatch.llm.common import annotate, kept_in_worker

# The split pattern of byte-level BPE, with White_Space spelled out.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = (rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+"
           rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")

NO_PAIR = np.int32(np.iinfo(np.int32).max)
CACHE_WORDS = 1 << 19
CACHE_LENGTH = 64


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBPE:
    """Counts the tokens of texts under the byte-level BPE file at ``path``."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec["pre_tokenizer"], spec["model"]
        if (pre["type"] != "ByteLevel" or pre["add_prefix_space"] or spec["normalizer"]
                or model["type"] != "BPE" or model.get("ignore_merges")):
            raise ValueError(f"{path} is no plain byte-level BPE")
        vocab = model["vocab"]
        self.first = np.zeros(256, np.int32)
        for letter, byte in _byte_letters().items():
            self.first[byte] = vocab[letter]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in merges], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.made = np.array([vocab[a + b] for a, b in merges], np.int32)
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError(f"{path} has added tokens that take white space along")
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.split = regex.compile(PATTERN).findall
        self.cache: dict[str, int] = {}

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_PAIR)

    def merged_lengths(self, words: list[bytes]) -> np.ndarray:
        """Symbols that survive in each word (none may be empty).

        All words lie behind one another in one array. In each round every word
        merges all places of its own lowest-ranked pair; words without a pair
        leave. A pair's product never has a rank below the pair itself, so
        this equals merging one place at a time.
        """
        lengths = np.array([len(w) for w in words], np.int64)
        symbols = self.first[np.frombuffer(b"".join(words), np.uint8)]
        out, names = lengths.copy(), np.arange(len(words))
        ends = np.cumsum(lengths) - 1
        ranks = np.full(len(symbols), NO_PAIR, np.int32)
        ranks[:-1] = self.pair_ranks(symbols[:-1], symbols[1:])
        ranks[ends] = NO_PAIR
        while len(names):
            starts = np.cumsum(lengths) - lengths
            lowest = np.minimum.reduceat(ranks, starts)
            live = lowest != NO_PAIR
            if not live.all():
                out[names[~live]] = lengths[~live]
                stay = np.repeat(live, lengths)
                symbols, ranks = symbols[stay], ranks[stay]
                names, lengths, lowest = names[live], lengths[live], lowest[live]
                if not len(names):
                    break
            owner = np.repeat(np.arange(len(names)), lengths)
            at = np.flatnonzero(ranks == lowest[owner])
            # In a run of overlapping places (aaaa) every second one merges.
            run = np.concatenate(([True], (np.diff(at) != 1) | (np.diff(owner[at]) != 0)))
            first = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - first) % 2 == 0]
            symbols[at] = self.made[ranks[at]]
            lengths -= np.bincount(owner[at], minlength=len(names))
            stay = np.ones(len(symbols), bool)
            stay[at + 1] = False
            last = np.cumsum(lengths) - 1
            symbols, ranks = symbols[stay], ranks[stay]
            at = at - np.arange(len(at))
            near = np.unique(np.concatenate((at, at - 1)))
            near = near[(near >= 0) & (near < len(symbols) - 1)]
            ranks[near] = self.pair_ranks(symbols[near], symbols[near + 1])
            ranks[last] = NO_PAIR
        return out

    def counts(self, texts: list[str]) -> list[int]:
        split, cache = self.split, self.cache
        pieces, specials = [], []
        for text in texts:
            parts = self.special.split(text) if self.special else [text]
            specials.append(len(parts) - 1)
            pieces.append([w for p in parts for w in split(p)] if len(parts) > 1 else split(text))
        if len(cache) > CACHE_WORDS:
            cache.clear()
        new = list({w for words in pieces for w in words if w not in cache})
        known = dict(zip(new, self.merged_lengths([w.encode() for w in new]).tolist(),
                         strict=True)) if new else {}
        cache.update(known)
        found = [sum(map(cache.__getitem__, words)) + n
                 for words, n in zip(pieces, specials, strict=True)]
        for w in new:
            if len(w) > CACHE_LENGTH:
                del cache[w]
        return found


def count_tokens(df: DataFrame, path: str, text_col: str = "text",
                 n_bytes: str = "n_bytes", n_tokens: str = "n_tokens") -> DataFrame:
    """``df`` with the UTF-8 bytes and the tokens of each whole text.

    No begin, end or added special tokens; the string of a special token inside
    a text is that one token. A null or empty text has 0 bytes and 0 tokens.
    Rows keep their columns (those named like a result are replaced) and their
    number: repeated rows and null ids count like any other. One task holds
    about 2 MB of text at a time, or one text if that is longer.
    """
    def make():
        model = kept_in_worker(("byte_bpe", path), lambda: ByteBPE(path))
        return lambda texts: [[len(t.encode()) for t in texts], model.counts(texts)]

    return annotate(df, text_col, [StructField(n_bytes, LongType()),
                                   StructField(n_tokens, LongType())], make, keeps=True)
