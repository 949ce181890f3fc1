"""Backoff scores against counts in a dictionary."""

import math

import numpy as np
import pytest
from brute import awkward, fold, language_model, plain_words
from conftest import MEDIUM
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gatewatch.llm import ngram_lm, packing, queries
from gatewatch.llm.common import fold as fold_column
from gatewatch.llm.ngram_lm import BackoffAutomaton, Settings

S = Settings()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1)), st.integers(1, 7))
def test_numbers_survive_packing(numbers, ranges):
    array = np.sort(np.array(numbers, np.uint64))
    assert packing.unpack(packing.pack(array)).tolist() == array.tolist()
    signed = np.array(numbers, np.uint64).view(np.int64)
    assert packing.unpack_counts(packing.pack_counts(signed)).tolist() == signed.tolist()
    parts = packing.range_slices(array, ranges)
    assert [x for p in parts for x in array[p].tolist()] == array.tolist()
    assert all(int(x) * ranges >> 64 == k for k, p in enumerate(parts) for x in array[p])


def test_probabilities_of_a_context_add_up_to_one():
    words = {"a": 5, "b": 2, "end": 3}
    pairs = {"a": 4, "b": 0, "end": 1}
    counts = np.array([*words.values(), 0]), np.full(4, words["a"]), np.array([*pairs.values(), 0])
    automaton = BackoffAutomaton(*counts, total=10, distinct=3, settings=S)
    assert abs((10 ** automaton.root).sum() - 1) < 1e-12
    assert abs((10 ** automaton.traverse()).sum() - 1) < 1e-12
    # The failure arc and the root's arc give what the full formula gives.
    lower = (2 + 0.5) / (10 + 0.5 * 4)
    k = S.weight + S.share * 5
    assert math.isclose(10 ** automaton.traverse()[1], k * lower / (5 + k))


def compare(got, rows, teaches):
    expected = {}
    for row, values in zip(rows, language_model(rows, teaches, S.weight, S.share)):
        expected.setdefault(row[0], []).append(values)
    assert len(got) == len(rows)
    for r in got:
        assert any(
            (r["n_tokens"], r["n_known"], r["train_tokens"]) == values[:3]
            and math.isclose(r["base_score"], values[3], rel_tol=1e-9, abs_tol=1e-9)
            and math.isclose(r["score"], values[4], rel_tol=1e-9, abs_tol=1e-9)
            for values in expected[r["doc_id"]]), r


def test_whole_table(spark):
    rows = [(r["doc_id"], r["text"])
            for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").collect()]
    got = queries.op7_language_model(spark, MEDIUM).collect()
    compare(got, rows, lambda i: fold(i, 5) != 1)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held) * 0.9
    assert sum(r["score"] > r["base_score"] for r in held) > 0.8 * len(held)


@pytest.mark.parametrize("block_bytes", [1 << 24, 3000])
def test_awkward_documents(spark, block_bytes):
    df = awkward(spark)
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    got = ngram_lm.score_texts(df, fold_column("doc_id", 5) != 1, block_bytes=block_bytes)
    assert got.columns == [*(c for c in df.columns if c not in ("text", "n_tokens", "score")),
                           "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    compare(got.collect(), rows, lambda i: fold(i, 5) != 1)
    assert all(r["block"] == "mine" for r in got.collect())
    assert ngram_lm.score_texts(df.limit(0), F.lit(True)).collect() == []
    nothing = ngram_lm.score_texts(df, F.lit(False)).collect()
    assert {(r["train_tokens"], r["n_known"], r["base_score"]) for r in nothing} == {(0, 0, 0.0)}


def test_words_are_those_of_the_contract():
    block = ngram_lm.Block(["A b\x1fc\x0b D", None, ""], 42)
    assert block.lengths.tolist() == [len(plain_words("A b\x1fc\x0b D")) + 1, 1, 1]


def test_columns_named_like_helpers_stay(spark):
    df = awkward(spark).withColumns({n: F.lit("mine") for n in ("_block", "_teaches")})
    got = ngram_lm.score_texts(df, F.lit(True)).collect()
    assert len(got) == df.count() and all(r["_block"] == r["_teaches"] == "mine" for r in got)
