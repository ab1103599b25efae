"""Byte-level BPE with a sentencepiece model made directly from a rank file.

Every byte becomes one character, every vocabulary entry a piece of such characters
whose score is its negative rank, and nothing is normalised.  The library's merge
order is then that of the ranks: best score first, leftmost on ties.  Pre-tokens are
encoded one by one; ids are decoded by the inverse mapping of their pieces.
"""

from __future__ import annotations

import base64
import itertools
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from releasemill.llm.frames import extended

# Characters that stand for the bytes 0 to 255.
FIRST_CHARACTER = 0x100
TO_CHARACTERS = {b: FIRST_CHARACTER + b for b in range(256)}
TO_BYTES = {FIRST_CHARACTER + b: b for b in range(256)}

UNKNOWN_PIECE = "<unk>"

# Bytes of pre-tokens that a task remembers, the overhead of one, and pre-tokens
# handled at once in a long text.
MEMORY = 24 << 20
ENTRY = 200
AT_ONCE = 1 << 16
# Rows that leave a task at once, with their texts' bytes.
ROWS = 64


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}


# --- the model file ------------------------------------------------------------------


def _varint(value: int) -> bytes:
    out = bytearray()
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    out.append(value)
    return bytes(out)


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _real(field: int, value: float) -> bytes:
    return _varint(field << 3 | 5) + struct.pack("<f", value)


def _bytes(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def serialise(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece BPE model whose piece ids are the ranks.

    Ranks without an entry get pieces that no text contains; one piece for
    unknown characters follows the last rank.
    """
    missing = [b for b in range(256) if bytes([b]) not in ranks]
    if missing:
        raise ValueError(f"vocabulary lacks the bytes {missing}")
    by_rank = {rank: token for token, rank in ranks.items()}
    if len(by_rank) != len(ranks):
        raise ValueError("two entries share a rank")
    size = max(by_rank) + 1
    # Field numbers and enumerations of the model format.
    normal, unknown, unused, bpe = 1, 2, 5, 2
    model = bytearray()
    for rank in range(size):
        token = by_rank.get(rank)
        piece = f"<unused {rank}>" if token is None else token.decode("latin-1").translate(TO_CHARACTERS)
        body = _bytes(1, piece.encode()) + _real(2, -float(rank))
        model += _bytes(1, body + _number(3, unused if token is None else normal))
    model += _bytes(1, _bytes(1, UNKNOWN_PIECE.encode()) + _real(2, 0.0) + _number(3, unknown))
    trainer = _number(3, bpe) + _number(4, size + 1) + _number(40, size)
    off = (1 << 64) - 1  # -1: no such piece
    trainer += _number(41, off) + _number(42, off) + _number(43, off)
    normaliser = _bytes(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return bytes(model + _bytes(2, trainer) + _bytes(3, normaliser))


class Codec:
    """Encodes and decodes texts with a serialised model; remembers pre-tokens."""

    def __init__(self, model: bytes, pattern: str):
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.pattern = regex.compile(pattern)
        pieces = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size() - 1)]
        inner = [not self.library.is_unused(i) for i in range(len(pieces))]
        self.bytes_of = [
            p.translate(TO_BYTES).encode("latin-1") if real else b"" for p, real in zip(pieces, inner)
        ]
        self.whole = {b: i for i, b in enumerate(self.bytes_of) if inner[i]}
        self.known: dict[str, bytes] = {}
        self.size = 0

    def learn(self, tokens: set[str]) -> None:
        """Encode pre-tokens that are not remembered yet."""
        new = [t for t in tokens if t not in self.known]
        if self.size > MEMORY:
            self.known.clear()
            self.size, new = 0, list(tokens)
        # A character and its ids take eight bytes or less, as a rule.
        self.size += sum(map(len, new)) * 8 + len(new) * ENTRY
        split = []
        for token in new:
            raw = token.encode("utf-8")
            whole = self.whole.get(raw)
            if whole is None:
                split.append((token, raw.decode("latin-1").translate(TO_CHARACTERS)))
            else:
                self.known[token] = struct.pack("<I", whole)
        if split:
            coded = self.library.encode([text for _, text in split], out_type=int, num_threads=1)
            for (token, _), ids in zip(split, coded):
                self.known[token] = struct.pack(f"<{len(ids)}I", *ids)

    def parts(self, text: str) -> Iterator[list[str]]:
        """The pre-tokens, in lists of bounded length."""
        if len(text) <= AT_ONCE:
            yield self.pattern.findall(text)
            return
        found = (match.group() for match in self.pattern.finditer(text))
        while part := list(itertools.islice(found, AT_ONCE)):
            yield part

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        out = []
        for tokens in self.parts(text or ""):
            self.learn(set(tokens))
            out.append(b"".join(map(self.known.__getitem__, tokens)))
        return b"".join(out)

    def decode(self, ids: bytes | None) -> bytes:
        numbers = np.frombuffer(ids or b"", dtype="<u4")
        return b"".join(
            b"".join(map(self.bytes_of.__getitem__, numbers[k : k + AT_ONCE].tolist()))
            for k in range(0, len(numbers), AT_ONCE)
        )


# --- operators -----------------------------------------------------------------------


def encoded(frame: DataFrame, model: bytes, pattern: str, text: str = "text") -> DataFrame:
    """`frame` with `text` replaced by `n_tokens` and `ids` (little-endian 32-bit, packed).

    Null counts as empty and has no ids.  The model, bounded by its vocabulary,
    travels with the tasks.  Rows stay as many as they are.
    """

    def make():
        codec = Codec(model, pattern)

        def compute(texts):
            ids = [codec.encode(t) for t in texts]
            return [[len(x) // 4 for x in ids], ids]

        return compute

    fields = [("n_tokens", "long", pa.int64()), ("ids", "binary", pa.binary())]
    return extended(frame.withColumn(text, F.col(text).cast("string")), text, fields, make)


def decoded(frame: DataFrame, model: bytes, pattern: str, ids: str = "ids") -> DataFrame:
    """`frame` with `ids` replaced by the `decoded` bytes; null counts as no ids."""

    def make():
        codec = Codec(model, pattern)
        return lambda values: [[codec.decode(v) for v in values]]

    return extended(frame, ids, [("decoded", "binary", pa.binary())], make)


def round_trip(docs: DataFrame, model: bytes, pattern: str, keep: list[str],
               text: str = "text", decoded: bool = True) -> DataFrame:
    """`keep` columns of every row with `n_tokens`, `ids`, and the `decoded` bytes of the ids.

    One codec encodes and decodes in one pass.  Without `decoded`, its place is taken by
    `same`: whether the ids decode to the text (null: empty), so that long texts are not
    carried on.
    """

    def make():
        codec = Codec(model, pattern)

        def compute(texts):
            ids = [codec.encode(t) for t in texts]
            back = map(codec.decode, ids)
            if not decoded:
                back = (b == (t or "").encode("utf-8") for b, t in zip(back, texts))
            return [[len(x) // 4 for x in ids], ids, list(back)]

        return compute

    last = ("decoded", "binary", pa.binary()) if decoded else ("same", "boolean", pa.bool_())
    fields = [("n_tokens", "long", pa.int64()), ("ids", "binary", pa.binary()), last]
    source = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string").alias("__text"))
    return extended(source, "__text", fields, make, ROWS)
