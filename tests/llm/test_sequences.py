"""Packing: pieces against the tokenizer library, packings against what any packing needs."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from brute import awkward
from conftest import MEDIUM
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gatewatch.llm import queries, sequences
from gatewatch.llm.sequences import Encoder, Settings, cut_documents, pack

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return Encoder(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(st.one_of(
    st.text(max_size=60), st.text("ab 'sLl\n", max_size=40),
    st.sampled_from(["<|endoftext|>", "x <|startoftext|>y", " é ́a", "İ Σς ΑΣ",
                     "a\x1cb\x85c\xa0d e", "I'll WE'VE 's"])), max_size=5))
def test_words_are_encoded_as_in_their_text(encoder, library, texts):
    assert [np.frombuffer(b, "<u4").tolist() for b in encoder.encoded(texts)] == [
        ids_of(library, t) for t in texts]


def check(rows, capacity):
    """Every sequence is gapless from 0 and holds at most ``capacity``; returns their number."""
    held = {}
    for r in rows:
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in held.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(held)


def test_query_equals_the_library_and_wastes_nothing(spark, library):
    rows = [r.asDict() for r in queries.op12_best_fit_packing(spark, MEDIUM).collect()]
    texts = dict(spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text")
                 .collect())
    found = {}
    for r in rows:
        found.setdefault(r["doc_id"], []).append(r)
    assert found.keys() == texts.keys()
    for doc, pieces in found.items():
        ids = np.array([*ids_of(library, texts[doc]), 0], "<u4")
        pieces.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in pieces] == list(range(-(-len(ids) // 2048)))
        for r in pieces:
            part = ids[r["start"]:r["start"] + 2048]
            assert r["start"] == 2048 * r["piece"] and r["length"] == len(part)
            assert r["ids_crc32"] == zlib.crc32(part.tobytes())
    lengths = np.array([r["length"] for r in rows])
    assert check(rows, 2048) <= sequences.least_bins(lengths, 2048) + 1


def test_awkward_documents(spark, library):
    df = awkward(spark)
    rows = cut_documents(df, PATH, 64, ids="list")
    packed = pack(rows, settings=Settings(capacity=64))
    found = packed.collect()
    want = sorted((r["doc_id"] is None, r["doc_id"] or 0, k // 64, [*ids_of(library, r["text"]), 0]
                   [k:k + 64]) for r in df.collect()
                  for k in range(0, len(ids_of(library, r["text"])) + 1, 64))
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["piece"], r["list"])
                  for r in found) == want
    check(found, 64)
    whole = {r["sequence_id"]: r["list"] for r in sequences.sequences(packed, "list").collect()}
    for r in found:
        assert whole[r["sequence_id"]][r["offset"]:r["offset"] + r["length"]] == r["list"]
    assert pack(rows.limit(0)).collect() == []
    assert cut_documents(df.limit(0), PATH).collect() == []


def test_clashing_columns_and_many_levels(spark):
    """Small blocks, so that several levels of released bins follow each other."""
    rng = np.random.default_rng(2)
    rows = [(int(n), "x", 1, 2, 3) for n in rng.integers(1, 60, 3000)]
    df = spark.createDataFrame(rows, "length long, _block string, _row int, block int, offset int")
    out = pack(df.repartition(5), settings=Settings(capacity=100, block=200, epochs=2))
    assert out.columns == ["length", "_block", "_row", "block", "sequence_id", "offset"]
    found = out.collect()
    lengths = np.array([r[0] for r in rows])
    assert sorted(r["length"] for r in found) == sorted(lengths.tolist())
    assert check(found, 100) <= sequences.least_bins(lengths, 100) * 1.01 + 2


def test_bins_that_hold_whole_blocks_end_the_levels(spark):
    df = spark.range(1000).selectExpr("CAST(1 AS BIGINT) AS length")
    found = pack(df, settings=Settings(capacity=10_000, block=100, epochs=1)).collect()
    assert len(found) == 1000 and check(found, 10_000) <= 10


def test_one_length_of_a_third_of_all_rows(spark):
    df = spark.range(6000).selectExpr("CAST(IF(id % 3 = 0, 700, id % 2000 + 1) AS BIGINT) AS length")
    found = pack(df, settings=Settings(block=1000)).collect()
    lengths = -np.sort(-np.array([r["length"] for r in found]))
    whole: list[int] = []
    sequences.best_fit(lengths, np.arange(6000), np.zeros(6000, np.int64), whole, 2048)
    assert check(found, 2048) <= len(whole) * 1.005 + 1


@settings(max_examples=60, deadline=None)
@given(lengths=st.lists(st.integers(1, 30), min_size=1, max_size=60), seed=st.integers(0, 99))
def test_children_are_packings(lengths, seed):
    lengths, rng = np.array(lengths), np.random.default_rng(seed)
    setting = Settings(capacity=30)
    packings = sequences.first_packings(lengths, setting, rng)
    one, two = packings[0], packings[-1]
    child = sequences.crossover(lengths, one, two, 0.3, 30, rng)
    for bins in (one, two, child, sequences.mutated(lengths, child, 30, rng)):
        full = sequences.fills(lengths, bins)
        assert full.min() > 0 and full.max() <= 30 and full.sum() == lengths.sum()
        assert len(full) >= sequences.least_bins(lengths, 30)


def test_crossover_keeps_injected_bins_whole():
    lengths = np.array([9, 1, 8, 2, 7, 3, 6, 4, 5, 5])
    one = np.array([0, 0, 1, 1, 2, 2, 3, 3, 4, 4])
    two = np.array([0, 1, 2, 1, 3, 1, 4, 1, 5, 6])
    child = sequences.crossover(lengths, one, two, 1.0, 10, np.random.default_rng(0))
    assert sequences.fills(lengths, child).tolist() == [10] * 5


def test_evolution_beats_best_fit():
    """Lengths of perfect triples, on which best fit by falling length wastes bins."""
    rng = np.random.default_rng(8)
    a, b = rng.integers(300, 400, 60), rng.integers(260, 330, 60)
    lengths = -np.sort(-np.concatenate([a, b, 1000 - a - b]))
    setting = Settings(capacity=1000, generations=400)
    plain: list[int] = []
    sequences.best_fit(lengths, np.arange(180), np.zeros(180, np.int64), plain, 1000)
    found = sequences.evolved(lengths, sequences.first_packings(lengths, setting, rng), setting, rng)
    assert int(found[0].max()) + 1 < len(plain)


def brute_least(lengths, capacity):
    best = len(lengths)

    def place(k, free):
        nonlocal best
        if len(free) >= best:
            return
        if k == len(lengths):
            best = len(free)
            return
        for j, space in enumerate(free):
            if space >= lengths[k]:
                place(k + 1, [*free[:j], space - lengths[k], *free[j + 1:]])
        place(k + 1, [*free, capacity - lengths[k]])

    place(0, [])
    return best


@settings(max_examples=60, deadline=None)
@given(lengths=st.lists(st.integers(1, 12), min_size=1, max_size=7))
def test_bound_is_a_bound(lengths):
    assert sequences.least_bins(np.array(lengths), 12) <= brute_least(lengths, 12)


def test_cases_and_signs_of_known_words_do_not_go_to_the_library(library, monkeypatch):
    own = Encoder(PATH)
    own.encoded(["house été , *** ("])
    asked = []
    learn = own._learn
    monkeypatch.setattr(own, "_learn", lambda words, *rest: (asked.extend(words),
                                                             learn(words, *rest)))
    text = "House, HOUSE*** house, Été, ÉTÉ*** été,"
    own.encoded([text])
    assert asked == []
    # Letters whose lower case is two or joins what follows, marks, numbers, apostrophes.
    texts = [text, "İ, İ. ß, ẞ, ÿ, Ÿ, µ, ǅ, é, É́, é̸= a²,", "don't, It's. l'été,",
             "Ab<, ab<|endoftext|>, a_b, ab1, x×, x÷, ª, 'house, House'"]
    for found, wanted in zip(own.encoded(texts), texts):
        assert np.frombuffer(found, "<u4").tolist() == library.encode(
            wanted, add_special_tokens=False).ids
