"""Toxicity scores of a factorization machine over hashed terms."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DoubleType, IntegerType, StructField)

from gatewatch.llm.common import annotate

_WORD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128
              else 32 for c in range(256))


CACHE_WORDS = 1 << 17


@dataclass(frozen=True)
class Settings:
    """``sample_rows`` bounds the labelled rows that the machine is fitted on;
    term statistics come from the same rows."""
    bits: int = 20
    prefixes: tuple[int, ...] = (4, 5, 6)
    sample_rows: int = 12_000
    min_documents: int = 3
    min_z: float = 3.5
    max_terms: int = 4096
    factors: int = 4
    epochs: int = 120
    rate: float = 0.1
    shrink: float = 3e-5
    seed: int = 7


class Terms:
    """Hashed terms of a text: its words, and their first letters marked as such."""

    def __init__(self, settings: Settings):
        self.bits, self.prefixes = settings.bits, settings.prefixes
        self.cache: dict[bytes, tuple[int, ...]] = {}

    def of_word(self, word: bytes) -> tuple[int, ...]:
        forms = [b"w" + word]
        text = word.decode("utf-8", "ignore")
        forms += [b"p" + text[:n].encode() for n in self.prefixes if len(text) > n]
        return tuple(xxhash.xxh64_intdigest(f, 0) >> (64 - self.bits) for f in forms)

    def of_text(self, text: str) -> set[int]:
        cache, found = self.cache, set()
        for w in set(text.encode().translate(_WORD).split(b" ")):
            terms = cache.get(w)
            if terms is None:
                if len(cache) > CACHE_WORDS:
                    cache.clear()
                terms = cache[w] = self.of_word(w) if w else ()
            found.update(terms)
        return found


@dataclass
class Machine:
    """Score = sigmoid(bias + sum of weights + sum of the terms' pairwise products)."""
    settings: Settings
    terms: np.ndarray  # chosen hashes, ascending
    bias: float
    weights: np.ndarray
    factors: np.ndarray  # terms x factors

    def margin(self, rows: list[np.ndarray]) -> np.ndarray:
        """Rows hold places in ``terms``, each once."""
        out = np.full(len(rows), self.bias)
        for k, at in enumerate(rows):
            if len(at):
                v = self.factors[at]
                s = v.sum(axis=0)
                out[k] += self.weights[at].sum() + 0.5 * (s @ s - (v * v).sum())
        return out


def _places(chosen: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Places in ``chosen`` of those of the terms that are there."""
    if not len(chosen) or not len(seen):
        return np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(chosen, seen), len(chosen) - 1)
    return np.sort(at[chosen[at] == seen])


def _choose(rows: list[np.ndarray], labels: np.ndarray, s: Settings) -> np.ndarray:
    """Terms whose document frequency differs between the labels (two-proportion z)."""
    size = 1 << s.bits
    total, ones = np.zeros(size), np.zeros(size)
    for r, y in zip(rows, labels, strict=True):
        total[r] += 1
        if y:
            ones[r] += 1
    n, n1 = len(labels), labels.sum()
    if n1 in (0, n):
        return np.zeros(0, np.int64)
    rest = total - ones
    pooled = (total + 1) / (n + 2)
    z = ((ones + 0.5) / (n1 + 1) - (rest + 0.5) / (n - n1 + 1)) / np.sqrt(
        pooled * (1 - pooled) * (1 / n1 + 1 / (n - n1)))
    z[total < s.min_documents] = 0
    order = np.argsort(-np.abs(z), kind="stable")[:s.max_terms]
    return np.sort(order[np.abs(z[order]) >= s.min_z])


def fit(documents: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
        settings: Settings = Settings()) -> Machine:
    """A machine fitted on about ``settings.sample_rows`` labelled documents.

    The sample is chosen by a digest of the ids, so it does not depend on files
    or tasks, and joined as a broadcast of that bound. An id counts once (with
    its greatest label, and the text of the least digest). The hashed terms of
    the sample, not its texts, come to the driver. Null labels are left out;
    without both labels present the machine gives one constant score.
    """
    terms = Terms(settings)
    known = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("id"))
             .agg(F.max(F.col(label_col).cast("int")).alias("label")))
    n = max(known.count(), 1)
    draw = F.pmod(F.xxhash64("id", F.lit(settings.seed)), F.lit(1 << 30))
    known = known.where(draw < int((1 << 30) * min(1.0, settings.sample_rows / n)))
    rows = annotate(
        documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .join(F.broadcast(known), "id"),
        "text", [StructField("terms", ArrayType(IntegerType()))],
        lambda: lambda texts: [[sorted(terms.of_text(t)) for t in texts]])
    sample = (rows.groupBy("id").agg(F.min_by(F.struct("label", "terms"), F.xxhash64("text"))
                                     .alias("row"))
              .select("id", "row.*").toArrow().sort_by("id").combine_chunks())
    labels = sample["label"].to_numpy().astype(np.float64)
    lists = sample["terms"].combine_chunks()
    flat, ends = lists.flatten().to_numpy(), np.cumsum(
        lists.value_lengths().to_numpy())
    found = np.split(flat, ends[:-1]) if len(ends) else []
    chosen = _choose(found, labels, settings)
    places = [_places(chosen, r) for r in found]
    return _descend(chosen, places, labels, settings)


def _descend(chosen: np.ndarray, rows: list[np.ndarray], y: np.ndarray, s: Settings) -> Machine:
    """AdaGrad on the logistic loss, with the gradient of all rows in each step."""
    n, m = len(rows), len(chosen)
    share = (y.sum() + 0.5) / (n + 1)
    rng = np.random.default_rng(s.seed)
    bias = float(np.log(share / (1 - share)))
    w, v = np.zeros(m), rng.normal(0, 0.01, (m, s.factors))
    if not m or not n:
        return Machine(s, chosen, bias, w, v)
    lengths = np.array([len(r) for r in rows])
    owner = np.repeat(np.arange(n, dtype=np.int32), lengths)
    at = np.concatenate(rows).astype(np.int32)
    gb, gw, gv = 1e-8, np.full(m, 1e-8), np.full((m, s.factors), 1e-8)
    for _ in range(s.epochs):
        # One factor at a time, so that the driver holds few arrays of that length.
        margin, sums = bias + np.bincount(owner, w[at], n), []
        for f in range(s.factors):
            own = v[at, f]
            sums.append(np.bincount(owner, own, n))
            margin += 0.5 * (sums[f] ** 2 - np.bincount(owner, own * own, n))
        error = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y
        per = error[owner]
        db = error.mean()
        dw = np.bincount(at, per, m) / n + s.shrink * w
        dv = np.stack([np.bincount(at, per * (sums[f][owner] - v[at, f]), m)
                       for f in range(s.factors)], axis=1) / n + s.shrink * v
        gb, gw, gv = gb + db * db, gw + dw * dw, gv + dv * dv
        bias -= s.rate * db / np.sqrt(gb)
        w -= s.rate * dw / np.sqrt(gw)
        v -= s.rate * dv / np.sqrt(gv)
    return Machine(s, chosen, bias, w, v)


def score(df: DataFrame, machine: Machine, text_col: str = "text",
          out: str = "score") -> DataFrame:
    """``df`` with a score from 0 to 1 of each whole text; empty and null texts get
    the score of the bias alone. Rows and other columns stay as they are."""
    def make():
        terms, chosen = Terms(machine.settings), set(machine.terms.tolist())

        def work(texts: list[str]) -> list:
            rows = [_places(machine.terms, np.array(sorted(terms.of_text(t) & chosen), np.int64))
                    for t in texts]
            return [(1 / (1 + np.exp(-np.clip(machine.margin(rows), -30, 30)))).tolist()]
        return work

    return annotate(df, text_col, [StructField(out, DoubleType())], make)
