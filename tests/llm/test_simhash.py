"""Fingerprints, links by blocks and components against all pairs."""

import random

import pytest
from brute import awkward, components, fingerprint, near_duplicates
from conftest import MEDIUM
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gatewatch.llm import queries, simhash
from gatewatch.llm import components as graph

BITS = st.integers(0, 2**64 - 1)


@settings(max_examples=300, deadline=None)
@given(text=st.text(alphabet="aAbÜ \n\x1f", max_size=40), shingle=st.integers(1, 4))
def test_fingerprint(text, shingle):
    assert simhash.fingerprint(text, shingle) == fingerprint(text, shingle)


@settings(max_examples=300, deadline=None)
@given(value=BITS, flips=st.lists(st.integers(0, 63), max_size=3), blocks=st.integers(4, 8))
def test_close_pairs_share_a_choice_of_blocks(value, flips, blocks):
    other = value
    for b in flips:
        other ^= 1 << b
    distance = (value ^ other).bit_count()
    masks = simhash.block_masks(3, blocks)
    assert distance <= 3 and any(value & m == other & m for m in masks)
    assert all(m < 2**64 for m in masks)


@pytest.mark.parametrize("group_rows", [4096, 8])
def test_links_keep_components_together(spark, monkeypatch, group_rows):
    """Also where a key has many fingerprints and is cut into chunks."""
    monkeypatch.setattr(simhash, "GROUP_ROWS", group_rows)
    rng = random.Random(4)
    values = {0, 2**64 - 1, 2**63}
    for _ in range(6):  # clouds of close values, and chains that lead away from them
        v = rng.getrandbits(64)
        for _ in range(60):
            values.add(v ^ 1 << rng.randrange(64))
            if rng.random() < 0.2:
                v ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
    values |= {rng.getrandbits(64) for _ in range(100)}
    signed = {v: v - 2**64 if v >= 2**63 else v for v in values}
    fps = spark.createDataFrame([(s,) for s in signed.values()], "fp long")
    links = simhash.link_fingerprints(fps, 2).collect()
    back = {s: v for v, s in signed.items()}
    assert all((back[r["a"]] ^ back[r["b"]]).bit_count() <= 2 for r in links)
    roots = {r["node"]: r["root"] for r in graph.components(
        spark.createDataFrame(links, "a long, b long")).collect()}
    groups = {}
    for v, s in signed.items():
        groups.setdefault(roots.get(s, s), set()).add(v)
    expected = {}
    for v, r in components(list(values), 2).items():
        expected.setdefault(r, set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_components_of_chains_stars_and_rings(spark):
    n = 300
    links = [(k, k + 1) for k in range(n)] + [(1000, 1000 + k) for k in range(1, 200)]
    links += [(3000 + k, 3000 + (k + 1) % 50) for k in range(50)] + [(5, 5), (3, 2), (2, 3)]
    random.Random(2).shuffle(links)
    got = graph.components(spark.createDataFrame(links, "a long, b long")).collect()
    roots = {r["node"]: r["root"] for r in got}
    assert len(got) == len(roots)
    assert {roots[k] for k in range(n + 1)} == {0}
    assert {roots[1000 + k] for k in range(200)} == {1000}
    assert {roots[3000 + k] for k in range(50)} == {3000}
    empty = spark.createDataFrame([], "a long, b long")
    assert graph.components(empty).collect() == []


def test_whole_table(spark):
    docs = [(r["doc_id"], r["text"])
            for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").collect()]
    got = [tuple(r) for r in queries.op8_simhash(spark, MEDIUM).collect()]
    assert sorted(got) == sorted(near_duplicates(docs))


def test_awkward_documents(spark):
    df = awkward(spark)
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    got = [tuple(r) for r in simhash.near_duplicates(df).collect()]
    assert sorted(got, key=repr) == sorted(near_duplicates(rows), key=repr)
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns
    ids = [r["doc_id"] for r in kept.collect()]
    # Null, empty and blank texts are one group; so are the copies, repeated rows too.
    assert sorted(i for i in ids if i is not None) == [1, 4, 5, 7, 8, 9, 10]
    assert ids.count(None) == 1
    assert simhash.near_duplicates(df.limit(0)).collect() == []
    assert simhash.keep_first(df.limit(0)).collect() == []
    alone = df.where(F.col("doc_id").isNull())
    assert {r["component_id"] for r in simhash.near_duplicates(alone).collect()} == {None}
    assert simhash.keep_first(alone).count() == 2


def test_columns_named_like_helpers_stay(spark):
    df = awkward(spark).withColumns({n: F.lit("mine") for n in (
        "_id", "_none", "_fp", "_fingerprint", "__id", "least", "no_id", "c")})
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns
    rows = kept.collect()
    assert rows and all(r["_id"] == r["_fp"] == r["__id"] == r["_fingerprint"] == "mine"
                        for r in rows)
    plain = simhash.keep_first(awkward(spark))
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(
        str(r["doc_id"]) for r in plain.collect())
