"""Encoding and decoding against the library that the model file is for."""

import public_tokenizers
import pytest
import sentencepiece
from brute import LONG, awkward, sha256
from hypothesis import given, settings
from hypothesis import strategies as st

from gatewatch.llm.pieces import PieceModel, decode_pieces, encode_pieces, round_trip

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = st.one_of(st.text(max_size=60), st.text("ab ▁<0x>", max_size=40),
                  st.sampled_from(["  lead", "trail  ", "<s></s><unk><0x0A>", "\n\n\t", "日本 語"]))


@pytest.fixture(scope="module")
def model():
    return PieceModel(PATH)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@settings(max_examples=400, deadline=None)
@given(text=TEXTS)
def test_round_trip_is_that_of_the_library(model, library, text):
    ids = model.encode(text)
    assert ids == library.encode(text, add_eos=True)
    assert model.decode(ids) == library.decode(ids)


@settings(max_examples=400, deadline=None)
@given(ids=st.lists(st.one_of(st.integers(0, 300), st.integers(0, 31_999)), max_size=12))
def test_any_ids_decode_as_in_the_library(model, library, ids):
    assert model.decode(ids) == library.decode(ids)


def test_every_letter_and_long_text(model, library):
    texts = [f"a{chr(c)}b {chr(c)}{chr(c)}" for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    for text in [*texts, LONG, "ab" * 3000]:
        assert model.encode(text) == library.encode(text, add_eos=True)


def test_table_agrees_with_merging_one_by_one(model):
    for word in ("▁internationalisation", "▁strengthening", "▁▁▁xyzzy", "▁ñandú"):
        assert [model.shown(t) for t in model.tokens(word)] == model.merge(word)


def test_awkward_documents(spark, library):
    df = awkward(spark)
    got = round_trip(df, PATH, ids="ids").collect()
    assert len(got) == df.count()
    for r in got:
        ids = library.encode(r["text"] or "", add_eos=True)
        assert r["ids"] == ids and r["n_tokens"] == len(ids) and r["block"] == "mine"
        assert r["ids_sha256"] == sha256(" ".join(map(str, ids)))
        assert r["decoded_sha256"] == sha256(library.decode(ids))
    back = decode_pieces(encode_pieces(df.drop("id"), PATH), PATH).collect()
    assert sorted(r["text"] for r in back) == sorted(
        library.decode(library.encode(r["text"] or "", add_eos=True)) for r in got)
    assert round_trip(df.limit(0), PATH).collect() == []
