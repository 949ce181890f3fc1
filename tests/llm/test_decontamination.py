"""Benchmark words found by the automaton against sliding windows."""

import pytest
from brute import LONG, awkward, benchmark_words, decontaminated, sha256
from conftest import MEDIUM
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gatewatch.llm import decontamination, queries
from gatewatch.llm.decontamination import SuffixAutomaton, words_of

WORDS = st.lists(st.sampled_from("abc"), max_size=12).map(" ".join)


@settings(max_examples=300, deadline=None)
@given(items=st.lists(WORDS, max_size=5), text=WORDS, window=st.integers(1, 5))
def test_automaton_equals_sliding_windows(items, text, window):
    named = [(str(k), t) for k, t in enumerate(items)]
    words = [w for w in words_of(text) if w]
    spans, found = SuffixAutomaton(named, window).matches(words)
    n, hit, expected = decontaminated([text], named, window)[0]
    assert len(words) == n and found == expected
    assert {k for a, b in spans for k in range(a, b)} == hit


def test_longest_matches_are_carried_over_mismatches():
    automaton = SuffixAutomaton([("1", "a b c d"), ("2", "c d e f")], 3)
    spans, items = automaton.matches([w.encode() for w in "x a b c d e f y".split()])
    assert spans == [(1, 7)] and items == {"1", "2"}


def test_whole_table(spark):
    got = queries.op5_decontamination(spark, MEDIUM).collect()
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").collect()
    items = [(str(r["item_id"]), r["text"])
             for r in spark.read.parquet(f"{MEDIUM}/benchmark.parquet").collect()]
    expected = dict(zip((r["doc_id"] for r in docs),
                        decontaminated([r["text"] for r in docs], items)))
    assert len(got) == len(docs)
    for r in got:
        n, hit, found = expected[r["doc_id"]]
        assert (r["n_words"], r["n_hit"], r["n_items"]) == (n, len(hit), len(found))
        assert r["items_sha256"] == sha256(",".join(sorted(found)))
        assert r["contaminated"] == bool(hit)
    assert any(r["contaminated"] for r in got)


BENCHMARK = [(1, "one two three four five six seven eight nine ten eleven"), (2, "Same words, in two"),
             (3, None), (4, ""), (None, "tie tie tie"), (2, "Same words, in two")]


@pytest.mark.parametrize("block_bytes", [1 << 24, 40])
def test_awkward_documents_and_several_automata(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", block_bytes)
    df = awkward(spark)
    items = spark.createDataFrame(BENCHMARK, "item_id long, text string")
    named = [("" if i is None else str(i), t) for i, t in BENCHMARK]
    got = decontamination.find_matches(df, items).collect()
    assert len(got) == df.count()
    for r in got:
        n, hit, found = decontaminated([r["text"]], named)[0]
        assert r["n_words"] == n and set(r["items"]) == found and r["block"] == "mine"
        assert {k for s in r["hit_spans"] for k in range(s["start"], s["end"])} == hit
    empty = decontamination.find_matches(df, items.limit(0))
    assert all(not r["hit_spans"] and not r["items"] for r in empty.collect())
    assert decontamination.find_matches(df.limit(0), items).collect() == []


def test_removal_by_length_and_coverage(spark):
    passage = "one two three four five six seven eight nine ten eleven"
    texts = {1: f"Before, {passage.upper()}! and after it come these other words, more of them.",
             2: passage, 3: "nothing here", 4: None, 5: "", 6: LONG,
             7: f"{passage} " + "ü " * 30 + f"({passage})."}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    items = spark.createDataFrame([(1, passage)], "item_id long, text string")
    found = decontamination.find_matches(df, items)
    got = {r["doc_id"]: r["text"] for r in decontamination.remove_matches(found).collect()}
    assert got == {1: "Before, ! and after it come these other words, more of them.",
                   3: "nothing here", 4: None, 5: "", 6: LONG, 7: " " + "ü " * 30 + "()."}
    once = decontamination.decontaminate(df, items)
    assert {r["doc_id"]: r["text"] for r in once.collect()} == got and once.columns == df.columns
    kept = decontamination.remove_matches(found, min_words=12, max_coverage=1.0)
    assert {r["doc_id"]: r["text"] for r in kept.collect()} == texts
    assert kept.columns == ["doc_id", "text"]
    again = decontamination.find_matches(kept.where(F.col("doc_id") == 1), items).first()
    assert again["hit_spans"][0]["end"] - again["hit_spans"][0]["start"] == len(
        benchmark_words(passage))


def test_columns_named_like_helpers_stay(spark):
    df = awkward(spark).withColumns({n: F.lit("mine") for n in ("_kept", "_left", "items")})
    items = spark.createDataFrame([(1, "tie tie tie tie tie tie")], "item_id long, text string")
    got = decontamination.decontaminate(df, items, 4, min_words=1)
    assert got.columns == df.columns
    rows = got.collect()
    assert rows and all(r["_kept"] == r["_left"] == r["items"] == "mine" for r in rows)
    assert decontamination.decontaminate(df.limit(0), items).collect() == []
    assert len(decontamination.decontaminate(df, items.limit(0)).collect()) == df.count()
