"""Repeated substrings against a set of all windows."""

import random

import numpy as np
import pytest
from brute import awkward, kept, repeats, runs, sha256
from conftest import MEDIUM
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gatewatch.llm import queries, substrings
from gatewatch.llm.substrings import Settings


@settings(max_examples=200, deadline=None)
@given(pieces=st.lists(st.text("ab\x00", min_size=4, max_size=30), min_size=1, max_size=6))
def test_two_stage_sorting(pieces):
    """All windows of 4 bytes come in order, so equal ones are neighbours."""
    data = [p.encode() for p in pieces]
    size = np.array([len(d) for d in data])
    offset = np.cumsum(size) - size
    text = np.frombuffer(b"".join(data), np.uint8)
    got = substrings.sort_suffixes(text, offset, size, size - 3, 4)
    assert len(set(got.tolist())) == len(got)
    owner = np.searchsorted(offset, got, "right") - 1
    whole = [g for g, o in zip(got, owner) if g - offset[o] <= size[o] - 4]
    assert sorted(whole) == [o + k for o, n in zip(offset, size) for k in range(n - 3)]
    windows = [bytes(text[g:g + 4]) for g in whole]
    assert windows == sorted(windows)
    alike = substrings.common_prefix(text, np.array(whole), 4)
    assert alike.tolist() == [a == b for a, b in zip(windows, windows[1:])]


def texts(seed, n=120):
    rng = random.Random(seed)
    base = ["".join(rng.choice("ab") for _ in range(300)), "a" * 700, "ab" * 400, "to " * 200,
            "".join(rng.choice("abc \n\0é") for _ in range(2000))]
    out = []
    for i in range(n):
        text = ""
        for _ in range(rng.randrange(1, 5)):
            source = rng.choice(base)
            at = rng.randrange(len(source))
            text += source[at:at + rng.randrange(30, 400)] + rng.choice(["", "b", "zz", "é"])
        out.append((i, text if i % 17 else None))
    return [*out, (None, "a" * 150), (500, ""), (501, "x" * 99), (502, "x" * 100)]


def compare(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = substrings.report(substrings.find_repeats(df, **options)).collect()
    expected = repeats(rows, options.get("settings", Settings()).width)
    assert len(got) == len(rows)
    for r in got:
        covered = expected[r["doc_id"], r["text"]]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (
            len(covered), sum(covered), runs(covered)), r["doc_id"]
        assert r["kept_sha256"] == sha256(kept(r["text"], covered))


@pytest.mark.parametrize("crowd", [1000, 2, 0])
def test_texts_full_of_repeats(spark, crowd):
    """Also where all windows of a crowded anchor meet one by one."""
    compare(spark, texts(3), crowd=crowd)


def test_many_small_blocks_and_parts(spark, monkeypatch):
    monkeypatch.setattr(substrings, "SORT_BYTES", 500)
    compare(spark, texts(5), block_bytes=2000)


def test_short_windows(spark):
    compare(spark, texts(7, 40), settings=Settings(width=12, gram=4))


def test_parts_of_a_long_document(spark, monkeypatch):
    rng = random.Random(1)
    text = "".join(rng.choice("abcd ") for _ in range(4000))
    block = substrings.Block([1, 2], [text + text, text], Settings())
    monkeypatch.setattr(substrings, "PART_BYTES", 1000)
    pieces = block.pieces()
    windows = sorted((int(p) + k for p, n in zip(pieces.place, pieces.windows) for k in range(n)))
    assert windows == [*range(8000 - 99), *range(8000, 12000 - 99)]


def test_whole_table(spark):
    rows = [(r["doc_id"], r["text"])
            for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").collect()]
    expected = repeats(rows)
    got = queries.op10_suffix_dedup(spark, MEDIUM).collect()
    by_id = {i: (t, c) for (i, t), c in expected.items()}
    assert len(got) == len(rows)
    for r in got:
        text, covered = by_id[r["doc_id"]]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (
            len(covered), sum(covered), runs(covered))
        assert r["kept_sha256"] == sha256(kept(text, covered))


def test_awkward_documents(spark):
    df = awkward(spark)
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    expected = repeats(rows)
    found = substrings.find_repeats(df)
    assert found.columns == [*df.columns, "repeat_spans"]
    got = substrings.without_repeats(df)
    assert got.columns == df.columns and got.count() == df.count()
    for r in got.collect():
        # The text before the cut is found by the id; a cut letter goes whole.
        options = [kept(t, c).decode("utf-8", "ignore") if t is not None else None
                   for (i, t), c in expected.items() if i == r["doc_id"]]
        assert r["text"] in options and r["block"] == "mine"
    assert substrings.find_repeats(df.limit(0)).collect() == []


def test_columns_named_like_helpers_stay(spark):
    df = awkward(spark).withColumns({n: F.lit("mine") for n in ("_block", "__block", "bucket")})
    for got, columns in ((substrings.without_repeats(df), df.columns),
                         (substrings.find_repeats(df), [*df.columns, "repeat_spans"])):
        assert got.columns == columns
        assert all(r["_block"] == r["__block"] == "mine" for r in got.collect())
