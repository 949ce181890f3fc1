"""SimHash near-duplicates: fingerprints, blocks that close pairs share, components."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField

from gatewatch.llm.common import annotate, free_names
from gatewatch.llm.components import components, cut_lineage

BITS = 64
# Fingerprints under one block key that are compared in one go.
GROUP_ROWS = 4096


def fingerprint(text: str, shingle: int = 3) -> int:
    """Bits that are set in over half the XXH64 values (seed 42) of the word shingles.

    Words part at white space, A-Z in lower case. Fewer words than a shingle make
    one; no word gives zero.
    """
    words = text.encode().lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    hashes = np.array([xxhash.xxh64_intdigest(b" ".join(s), 42)
                       for s in zip(*(words[k:] for k in range(shingle)))], ">u8")
    total = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * total > len(hashes))
    return int.from_bytes(bits.tobytes(), "big")


def add_fingerprints(df: DataFrame, text_col: str = "text", shingle: int = 3,
                     out: str = "fingerprint") -> DataFrame:
    """``df`` with the fingerprint of each whole text as 16 lower-case hex digits."""
    def make():
        return lambda texts: [[f"{fingerprint(t, shingle):016x}" for t in texts]]
    return annotate(df, text_col, [StructField(out, StringType())], make)


def block_masks(distance: int, blocks: int) -> list[int]:
    """Masks of ``blocks - distance`` blocks: of any pair within the distance, one masks alike."""
    edges = [BITS * k // blocks for k in range(blocks + 1)]
    part = [(1 << edges[k + 1]) - (1 << edges[k]) for k in range(blocks)]
    return [sum(part[k] for k in chosen) for chosen in combinations(range(blocks),
                                                                    blocks - distance)]


def _forest(values: np.ndarray, left: np.ndarray, right: np.ndarray,
            distance: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the pairs left x right within the distance.

    Both sides hold places in ``values``. A breadth-first walk compares each
    value once with those of the other side that no walk has reached yet.
    """
    links = []
    open_left, open_right = left, right
    same = left is right
    while len(open_left):
        front = open_left[:1]
        open_left = open_left[1:]
        if same:
            open_right = open_left
        side = True  # the front is from the left side
        while len(front):
            rest = open_right if side else open_left
            if not len(rest):
                break
            found = []
            for v in front:
                near = np.bitwise_count(values[rest] ^ values[v]) <= distance
                if near.any():
                    links += [(int(v), int(x)) for x in rest[near]]
                    found.append(rest[near])
                    rest = rest[~near]
            if same:
                open_left = open_right = rest
            elif side:
                open_right = rest
            else:
                open_left = rest
            front = np.concatenate(found) if found else rest[:0]
            side = same or not side
    return links


def _links(batches, distance):
    """Rows come sorted by (key, i, j); a group may reach over batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        whole = pa.Table.from_batches(held)
        group = _group_starts(whole)
        if len(group) > 1:
            yield from _compared(whole.slice(0, group[-1]), group, distance)
            held = whole.slice(group[-1]).combine_chunks().to_batches()
    if held:
        whole = pa.Table.from_batches(held)
        yield from _compared(whole, [*_group_starts(whole), whole.num_rows], distance)


def _group_starts(whole: pa.Table) -> list[int]:
    key, i, j = (whole[c].to_numpy() for c in ("key", "i", "j"))
    if not len(key):
        return []
    new = (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
    return [0, *(np.flatnonzero(new) + 1).tolist()]


def _compared(whole: pa.Table, group: list[int], distance: int):
    values = whole["fp"].to_numpy().astype(np.int64).view(np.uint64)
    chunk, i, j = (whole[c].to_numpy() for c in ("chunk", "i", "j"))
    found = []
    for a, b in zip(group, group[1:]):
        if b - a < 2:
            continue
        rows = np.arange(a, b)
        if i[a] == j[a]:
            found += _forest(values, rows, rows, distance) if b - a > 2 else (
                [(a, a + 1)] if (int(values[a]) ^ int(values[a + 1])).bit_count() <= distance
                else [])
        else:
            found += _bipartite(values, rows[chunk[a:b] == i[a]], rows[chunk[a:b] == j[a]],
                                distance)
    if found:
        at = np.array(found)
        signed = values.view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(signed[at[:, 0]]), pa.array(signed[at[:, 1]])],
                                         names=["a", "b"])


def _bipartite(values, left, right, distance):
    if not len(left) or not len(right):
        return []
    return _forest(values, left, right, distance)


def link_fingerprints(fps: DataFrame, distance: int = 2, blocks: int = 5) -> DataFrame:
    """Links (a, b) between the distinct fingerprints of ``fps`` (column fp: long).

    Two fingerprints within ``distance`` bits agree on ``blocks - distance``
    blocks at least, so each choice of that many blocks is a key. Under each
    key the distances are counted and a spanning forest of the close pairs
    comes out; so all links between different texts stay connected, and no
    group emits all its pairs. A key with over GROUP_ROWS fingerprints is cut
    into chunks that meet two by two, each pair of chunks in a group of its own.
    """
    keys = fps.select("fp", F.explode(F.array(*(
        F.struct(F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(F.lit(_signed(m)))).alias("key"),
                 F.lit(k).alias("which"))
        for k, m in enumerate(block_masks(distance, blocks))))).alias("k")).select(
            "fp", F.col("k.key").alias("key"))
    hot = keys.groupBy("key").count().where(F.col("count") > GROUP_ROWS).select(
        "key", F.ceil(F.col("count") / F.lit(GROUP_ROWS / 2)).cast("int").alias("chunks"))
    dealt = (keys.join(hot, "key", "left")
             .withColumn("chunks", F.coalesce("chunks", F.lit(1)))
             .withColumn("chunk", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
             .select("key", "fp", "chunk", F.least("chunk", "other").alias("i"),
                     F.greatest("chunk", "other").alias("j")))
    return (dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "fp")
            .mapInArrow(lambda b: _links(b, distance), "a bigint, b bigint"))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _groups(marked: DataFrame, distance: int, blocks: int) -> DataFrame:
    """(fp, least, root): each fingerprint with its least id and its component's root."""
    distinct = marked.groupBy("fp").agg(F.min("id").alias("least"))
    roots = components(link_fingerprints(distinct.select("fp"), distance, blocks))
    return distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))


def _marked(df: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(id, fingerprint, fp) of each row, written to the shared checkpoint folder."""
    named = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return cut_lineage(add_fingerprints(named, "text", shingle).select(
        "id", "fingerprint", _number("fingerprint").alias("fp")))


def _number(fingerprint: str):
    return F.conv(fingerprint, 16, -10).cast("long")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, distance: int = 2, blocks: int = 5) -> DataFrame:
    """(id, fingerprint, component_id) for each row of ``df``.

    component_id is the least id reached over links of at most ``distance``
    differing bits, the row's own included; null ids take part and never are
    the least (alone among themselves they have a null component). Null and
    empty texts have fingerprint zero and link like any other. Repeated rows
    come out once each. Only ids and fingerprints are shuffled.
    """
    marked = _marked(df, id_col, text_col, shingle)
    rooted = _groups(marked, distance, blocks)
    merged = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    found = rooted.join(merged, "root").select("fp", "component_id")
    return marked.join(found, "fp").select(F.col("id").alias(id_col), "fingerprint",
                                           "component_id")


def keep_first(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               shingle: int = 3, distance: int = 2, blocks: int = 5) -> DataFrame:
    """``df`` with one row of each component: its least id (null only where it has no
    other), then its least fingerprint; of rows equal in both, one. Texts are
    shuffled once, by id and fingerprint, so copies spread evenly."""
    marked = _marked(df, id_col, text_col, shingle)
    mark, least, none, fp = keys = free_names(df, "_fingerprint", "_id", "_none", "_fp")
    first = F.min(F.struct(F.col("least").isNull().alias("no_id"), "least", "fp"))
    chosen = (_groups(marked, distance, blocks).groupBy("root").agg(first.alias("c"))
              .select(F.coalesce("c.least", F.lit(-1)).alias(least),
                      F.col("c.no_id").alias(none), F.col("c.fp").alias(fp)))
    own = F.col(f"`{id_col}`")
    rows = add_fingerprints(df, text_col, shingle, mark).withColumns({
        least: F.coalesce(own, F.lit(-1)), none: own.isNull(), fp: _number(mark)})
    return (rows.join(chosen, keys[1:], "left_semi").dropDuplicates(keys[1:])
            .select(*(F.col(f"`{c}`") for c in df.columns)))
