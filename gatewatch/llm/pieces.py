"""SentencePiece (merge type) encoding by a table of prefixes, and decoding."""

from __future__ import annotations

import hashlib
import re
from itertools import chain

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, IntegerType, LongType, StringType, StructField,
                               StructType)
from sentencepiece import sentencepiece_model_pb2

from gatewatch.llm.common import annotate, kept_in_worker

SPACE = "▁"
# Kinds of pieces in a model file (fixed values).
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
CACHE_CHUNKS = 3 << 17
CACHE_PAIRS = 1 << 19
CACHE_LENGTH = 64
# Token numbers beside the ids: the start of a text, and letters that are no piece.
START = (1 << 22) - 1
LETTER = 1 << 21
NO_MERGE = float("-inf")
# Stands for a byte token that is a letter only with others; in no UTF-8 text.
PART_OF_LETTER = b"\xff"


class PieceModel:
    """The vocabulary of a merge-type model with byte fallback and no normaliser.

    Merges join neighbours whose text together is a piece; the best score goes
    first, then the leftmost. The encoding of a prefix is a prefix of the
    encoding, if it ends where a token ends. So each prefix has one last token:
    the one that ends there, whose pair with the last token of what is before
    it stays apart when the two are encoded together.
    """

    def __init__(self, path: str):
        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        norm, train = proto.normalizer_spec, proto.trainer_spec
        if (train.model_type != train.BPE or not train.byte_fallback
                or norm.precompiled_charsmap or norm.remove_extra_whitespaces
                or not norm.escape_whitespaces or train.treat_whitespace_as_suffix
                or any(p.type in (USER, UNUSED) for p in proto.pieces)):
            raise ValueError(f"{path} is of another kind than this encoder is for")
        self.dummy_prefix = norm.add_dummy_prefix
        self.end_id = next(i for i, p in enumerate(proto.pieces)
                           if p.type == CONTROL and p.piece == train.eos_piece)
        self.pieces = [p.piece for p in proto.pieces]
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.scores = {p.piece: p.score for p in proto.pieces if p.type == NORMAL}
        self.byte_ids = {int(p.piece[1:-1], 16): i
                         for i, p in enumerate(proto.pieces) if p.type == BYTE}
        self.bytes = [b""] * len(self.pieces)
        for i, p in enumerate(proto.pieces):
            if p.type == NORMAL:
                self.bytes[i] = p.piece.replace(SPACE, " ").encode()
            elif p.type == UNKNOWN:
                self.bytes[i] = train.unk_surface.encode()
        self.byte_of = {i: bytes([b]) for b, i in self.byte_ids.items()}
        for i, byte in self.byte_of.items():
            self.bytes[i] = byte if byte < b"\x80" else PART_OF_LETTER
        self.controls = {i for i, p in enumerate(proto.pieces) if p.type == CONTROL}
        self.plain = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+").findall
        # No piece has a space after another letter: then no token crosses such a place.
        self.splits = all(SPACE not in p.lstrip(SPACE) for p in self.ids)
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.cache: dict[str, tuple[int, ...]] = {}

    def merge(self, text: str) -> list[str]:
        """Merging one place at a time; only for the few letters of a token or a pair."""
        parts, score = list(text), self.scores.get
        places = [score(a + b, NO_MERGE) for a, b in zip(parts, parts[1:])]
        while places:
            best = max(places)
            if best == NO_MERGE:
                break
            at = places.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del places[at]
            if at:
                places[at - 1] = score(parts[at - 1] + parts[at], NO_MERGE)
            if at < len(places):
                places[at] = score(parts[at] + parts[at + 1], NO_MERGE)
        return parts

    def shown(self, token: int) -> str:
        """A token's text. A letter that is no piece is LETTER plus its code point."""
        return self.pieces[token] if token < LETTER else chr(token - LETTER)

    def apart(self, left: int, right: int) -> bool:
        """Whether the tokens, one after the other, are their own encoding (left may be START)."""
        alone = [self.shown(t) for t in (left, right) if t != START]
        return self.merge("".join(alone)) == alone

    def tokens(self, text: str) -> list[int]:
        """The tokens of ``text``, from the table of each prefix's last token.

        The automaton names the pieces that end at a place longest first; the
        first that stays apart from the last token before it is the one.
        """
        last, known, done = [START] * (len(text) + 1), self.pairs, 0
        if len(known) > CACHE_PAIRS:
            known.clear()
        for end, (piece, n) in self.automaton.iter(text):
            end += 1
            if end <= done:
                continue
            while done < end - 1:  # no piece ended there
                done += 1
                last[done] = LETTER + ord(text[done - 1])
            pair = last[end - n] << 22 | piece
            ok = known.get(pair)
            if ok is None:
                ok = known[pair] = self.apart(last[end - n], piece)
            if ok:
                last[end] = piece
                done = end
        while done < len(text):
            done += 1
            last[done] = LETTER + ord(text[done - 1])
        out, at = [], len(text)
        while at:
            out.append(last[at])
            at -= len(self.pieces[last[at]]) if last[at] < LETTER else 1
        return out[::-1]

    def to_ids(self, tokens: list[int]) -> list[int]:
        out = []
        for t in tokens:
            if t < LETTER:
                out.append(t)
            else:
                out.extend(self.byte_ids[b] for b in chr(t - LETTER).encode())
        return out

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text, the end id last."""
        if not text:
            return [self.end_id]
        shown = (SPACE if self.dummy_prefix else "") + text.replace(" ", SPACE)
        cache = self.cache
        if len(cache) > CACHE_CHUNKS:
            cache.clear()
        chunks = self.plain(shown) if self.splits else [shown]
        parts = list(map(cache.get, chunks))
        for k, ids in enumerate(parts):
            if ids is None:
                chunk = chunks[k]
                parts[k] = ids = cache.get(chunk) or tuple(self.to_ids(self.tokens(chunk)))
                if len(chunk) <= CACHE_LENGTH:
                    cache[chunk] = ids
        out = list(chain.from_iterable(parts))
        out.append(self.end_id)
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of the ids. Runs of byte tokens that are no UTF-8 give U+FFFD for
        each wrong byte; control ids give nothing; one leading space goes."""
        table = self.bytes
        data = b"".join(map(table.__getitem__, ids))
        if PART_OF_LETTER in data:
            parts, run = [], []
            for i in ids:
                if table[i] == PART_OF_LETTER:
                    run.append(self.byte_of[i])
                    continue
                if run:
                    parts.append(_valid(b"".join(run)))
                    run = []
                parts.append(table[i])
            parts.append(_valid(b"".join(run)))
            data = b"".join(parts)
        head = next((i for i in ids if i not in self.controls), None)
        if self.dummy_prefix and head is not None and self.pieces[head].startswith(SPACE):
            data = data[1:]
        return data.decode()


def _valid(run: bytes) -> bytes:
    """UTF-8 with U+FFFD for each byte that belongs to no letter."""
    try:
        run.decode()
        return run
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(run):
            for n in (1, 2, 3, 4):
                try:
                    out.append(run[at:at + n].decode().encode())
                    at += n
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�".encode())
                at += 1
        return b"".join(out)


def encode_pieces(df: DataFrame, path: str, text_col: str = "text",
                  ids: str = "ids") -> DataFrame:
    """``df`` with the ids of each whole text, the end id last.

    A null or empty text has the end id alone. Rows keep their columns (one
    named like the result is replaced) and their number.
    """
    def make():
        model = kept_in_worker(("pieces", path), lambda: PieceModel(path))
        return lambda texts: [[model.encode(t) for t in texts]]

    return annotate(df, text_col, [StructField(ids, ArrayType(IntegerType()))], make,
                    keeps=True)


def round_trip(df: DataFrame, path: str, text_col: str = "text", n_tokens: str = "n_tokens",
               ids_sha256: str = "ids_sha256", decoded_sha256: str = "decoded_sha256",
               ids: str | None = None) -> DataFrame:
    """Encodes and decodes each text; digests come out, and the ids if they are named.

    Nulls, repeated rows and clashing columns as in ``encode_pieces``.
    """
    def make():
        model = kept_in_worker(("pieces", path), lambda: PieceModel(path))
        names = [str(i) for i in range(len(model.pieces))]

        def work(texts):
            found = [model.encode(t) for t in texts]
            return [[len(x) for x in found],
                    [hashlib.sha256(" ".join([names[i] for i in x]).encode()).hexdigest()
                     for x in found],
                    [hashlib.sha256(model.decode(x).encode()).hexdigest() for x in found],
                    *([found] if ids else [])]
        return work

    return annotate(df, text_col, [
        StructField(n_tokens, LongType()), StructField(ids_sha256, StringType()),
        StructField(decoded_sha256, StringType()),
        *([StructField(ids, ArrayType(IntegerType()))] if ids else [])], make, keeps=True)


def decode_pieces(df: DataFrame, path: str, ids: str = "ids", text_col: str = "text") -> DataFrame:
    """``df`` with the text of each list of ids; null lists give null texts."""
    kept = [c for c in df.columns if c.lower() != text_col.lower()]
    schema = StructType([df.schema[c] for c in kept] + [StructField(text_col, StringType())])

    def run(batches):
        model = kept_in_worker(("pieces", path), lambda: PieceModel(path))
        for batch in batches:
            texts = [None if x is None else model.decode(x)
                     for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept),
                                              pa.array(texts, pa.string())],
                                             names=[*kept, text_col])

    return df.select(*(F.col(f"`{c}`") for c in kept)).mapInArrow(run, schema)
