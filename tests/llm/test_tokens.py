"""Token counts against the library that the vocabulary file is for."""

import numpy as np
import public_tokenizers
import pytest
from brute import AWKWARD, LONG, awkward
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gatewatch.llm.tokens import ByteBPE, count_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def model():
    return ByteBPE(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def expected(library, texts):
    return [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(st.one_of(
    st.text(max_size=60), st.text("ab ", max_size=40),
    st.sampled_from(["<|endoftext|>", "x<|endoftext|> y", "I'll we've 'S", "  \n\n x"])), max_size=5))
def test_counts_are_those_of_the_library(model, library, texts):
    assert model.counts(texts) == expected(library, texts)


def test_every_letter(model, library):
    texts = [f"a{chr(c)}b {chr(c)}{chr(c)}1" for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    assert model.counts(texts) == expected(library, texts)


def test_long_words_without_a_break(model, library):
    rng = np.random.default_rng(1)
    texts = ["a" * 5001, "ab" * 4000, "".join(rng.choice(list("abcdefgh"), 30_000)), LONG]
    assert model.counts(texts) == expected(library, texts)


def test_awkward_documents(spark, library):
    df = awkward(spark)
    got = count_tokens(df, PATH)
    assert got.columns == [*(c for c in df.columns if c != "n_tokens"), "n_bytes", "n_tokens"]
    rows = got.collect()
    assert len(rows) == df.count() and all(r["block"] == "mine" for r in rows)
    for r in rows:
        text = r["text"] or ""
        assert r["n_bytes"] == len(text.encode())
        assert r["n_tokens"] == expected(library, [text])[0]
    assert len([r for r in rows if r["doc_id"] == 5]) == 3
    assert count_tokens(df.limit(0), PATH).collect() == []
    assert {r[0] for r in AWKWARD} <= {r["doc_id"] for r in rows}
