"""Plain versions of what the operators compute, and awkward documents."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import zlib

import xxhash
from pyspark.sql import functions as F

LONG = "long " * 30_000 + "x" * 40_000
AWKWARD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "same words in two rows, twice over"),
    (6, "same words in two rows, twice over"), (7, LONG), (8, "Ünïcödé 日本語 text 🙂 <|endoftext|>"),
    (9, "a\x00b \x1f ▁▁ end"), (10, "tie tie tie tie tie tie"),
]


def awkward(spark, repeat=True, extra=True):
    """Nulls, empty and long texts, a null id, repeated rows, columns that clash."""
    rows = [*AWKWARD, (None, "no id but words"), (None, None)]
    rows += [AWKWARD[4], AWKWARD[4]] if repeat else []
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    if extra:
        names = ["lang", "id", "label", "score", "n_tokens", "block", "bucket", "fp", "root",
                 "position", "total", "fingerprint", "kind", "count", "terms"]
        df = df.withColumns({n: F.lit(None if n == "lang" else "mine") for n in names})
    return df


def fold(doc_id, parts):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % parts


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lowered(text))


def benchmark_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def fingerprint(text, shingle=3):
    words = plain_words(text)
    parts = [" ".join(words[k:k + shingle]) for k in range(len(words) - shingle + 1)]
    parts = parts or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(values, distance):
    """For each value the least value that can be reached."""
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    distinct = sorted(set(values))
    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            if (a ^ b).bit_count() <= distance:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


def near_duplicates(rows, shingle=3, distance=2):
    """For each (id, text) its fingerprint and least reachable id."""
    prints = [fingerprint(t, shingle) for _, t in rows]
    root = components(prints, distance)
    least = {}
    for (i, _), p in zip(rows, prints):
        if i is not None:
            least[root[p]] = min(i, least.get(root[p], i))
    return [(i, f"{p:016x}", least.get(root[p])) for (i, _), p in zip(rows, prints)]


def decontaminated(texts, items, window=10):
    """(n_words, hit positions, items) of each text."""
    windows = collections.defaultdict(set)
    for item, text in items:
        words = benchmark_words(text)
        if 0 < len(words) < window:
            windows[tuple(words)].add(item)
        for k in range(len(words) - window + 1):
            windows[tuple(words[k:k + window])].add(item)
    out = []
    for text in texts:
        words, hit, found = benchmark_words(text), set(), set()
        for n in {len(w) for w in windows}:
            for k in range(len(words) - n + 1):
                at = windows.get(tuple(words[k:k + n]))
                if at:
                    found |= at
                    hit |= set(range(k, k + n))
        out.append((len(words), hit, found))
    return out


def repeats(rows, width=100):
    """Covered bytes of each (id, text), judged in the order of ids."""
    seen, out = set(), {}
    for i, text in sorted(set(rows), key=lambda r: (-1 << 63 if r[0] is None else r[0])):
        data = (text or "").encode()
        covered = bytearray(len(data))
        for k in range(len(data) - width + 1):
            part = data[k:k + width]
            if part in seen:
                covered[k:k + width] = b"\1" * width
            seen.add(part)
        out[i, text] = bytes(covered)
    return out


def runs(covered):
    return len(re.findall(b"\1+", covered))


def kept(text, covered):
    return bytes(b for b, c in zip((text or "").encode(), covered) if not c)


def sha256(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def language_model(rows, teaches, weight, share):
    """n_tokens, n_known, train_tokens, base score and score of each text."""
    tokens = [plain_words(t) + ["\0"] for _, t in rows]
    words, pairs, starts = collections.Counter(), collections.Counter(), 0
    for (i, _), w in zip(rows, tokens):
        if teaches(i):
            words.update(w)
            pairs.update(zip(["\1", *w], w))
            starts += 1
    total, distinct = sum(words.values()), len(words)
    words["\1"] = starts
    out = []
    for w in tokens:
        base = score = 0.0
        for a, b in zip(["\1", *w], w):
            p = (words[b] + 0.5) / (total + 0.5 * (distinct + 1))
            k = weight + share * words[a]
            base += math.log10(p)
            score += math.log10((pairs[a, b] + k * p) / (words[a] + k))
        out.append((len(w), sum(words[x] > 0 for x in w), total, base, score))
    return out
