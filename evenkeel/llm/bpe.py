"""Byte-level BPE encoding and decoding with a sentencepiece model serialised from the ranks alone.

Every byte is written as one character, so that a vocabulary entry is an ordinary piece; the score of a
piece is its negative rank, so that sentencepiece merges the pair of the least rank first, the leftmost
of equal ones, as byte-level BPE does. Pre-tokens are found by a pattern and encoded separately; decoding
maps the pieces back to their bytes. Nothing is trained.

Defined results: NULL text counts as empty (no ids, no bytes); a pre-token of any length is encoded whole;
text of repeated rows is encoded once per row; an empty table gives an empty table.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
import sentencepiece
from pyspark import Broadcast
from pyspark.sql import DataFrame

#: Characters that stand for the bytes 0 to 255: one block of letters without spaces or controls.
_FIRST = 0x100
_AS_TEXT = {b: chr(_FIRST + b) for b in range(256)}
#: Distinct pre-tokens remembered by a Python worker.
REMEMBERED = 400_000


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: int | float | bytes) -> bytes:
    """One protocol-buffer field: varint, 32-bit float or length-delimited."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def read_ranks(path: str) -> list[bytes]:
    """The entries of a rank file (base64 bytes and rank per line), by rank. Ranks must be 0, 1, 2 …"""
    found = {}
    with open(path, "rb") as lines:
        for line in lines:
            if line.strip():
                piece, rank = line.split()
                found[int(rank)] = base64.b64decode(piece)
    if sorted(found) != list(range(len(found))):
        raise ValueError("ranks have gaps")
    return [found[r] for r in range(len(found))]


def serialise(entries: list[bytes]) -> bytes:
    """A sentencepiece BPE model: ids are ranks, the unknown piece comes last."""
    normal, unknown, bpe = 1, 2, 2
    unk = "<unk>"
    model = bytearray()
    for rank, entry in enumerate(entries):
        text = "".join(_AS_TEXT[b] for b in entry).encode()
        model += _field(1, _field(1, text) + _field(2, -float(rank)) + _field(3, normal))
    model += _field(1, _field(1, unk.encode()) + _field(2, -float(len(entries))) + _field(3, unknown))
    absent = (1 << 64) - 1  # -1: no such piece
    trainer = _field(3, bpe) + _field(40, len(entries)) + _field(41, absent) + _field(42, absent)
    trainer += _field(43, absent) + _field(45, unk.encode())
    model += _field(2, trainer)
    model += _field(3, _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0))
    return bytes(model)


class Codec:
    """Encode texts to ids and ids to bytes with a serialised model; remembers pre-tokens it has encoded."""

    def __init__(self, model: bytes, pattern: str) -> None:
        self.model, self.pattern = model, pattern
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.find = regex.compile(pattern).findall
        size = self.pieces.get_piece_size() - 1
        self.bytes = [
            bytes(ord(c) - _FIRST for c in piece)
            for piece in self.pieces.id_to_piece(list(range(size)))
        ]
        self.decimal = [str(i) for i in range(size)]
        # What is remembered shares its numbers.
        self.ids = list(range(size + 1))
        self.known: dict[str, tuple[int, ...]] = {}

    def __reduce__(self):
        return Codec, (self.model, self.pattern)

    def _learn(self, tokens: set[str]) -> None:
        new = [t for t in tokens if t not in self.known]
        if not new:
            return
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = list(tokens)
        # latin-1 reads each byte as the character of that number; the shift gives its stand-in.
        shifted = [t.encode().decode("latin-1").translate(_AS_TEXT) for t in new]
        ids = self.pieces.encode(shifted, out_type=int, num_threads=1)
        shared = self.ids.__getitem__
        self.known.update(zip(new, (tuple(map(shared, i)) for i in ids), strict=True))

    def encode(self, text: str | None) -> list[int]:
        tokens = self.find(text) if text else []
        self._learn(set(tokens))
        ids: list[int] = []
        for found in map(self.known.__getitem__, tokens):
            ids += found
        return ids

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


@lru_cache(maxsize=2)
def codec(model: bytes, pattern: str) -> Codec:
    return Codec(model, pattern)


def _shipped(docs: DataFrame, ranks_path: str, pattern: str) -> Broadcast[Codec]:
    """The codec, for tasks.

    A worker's codec, with the pre-tokens it remembers, belongs to the broadcast: it is one for all tasks of the stage and
    goes when the worker, which serves later stages too, gets a task without it."""
    return docs.sparkSession.sparkContext.broadcast(codec(serialise(read_ranks(ranks_path)), pattern))


def encode(
    docs: DataFrame, ranks_path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, ids array<int>): every text encoded."""
    shipped = _shipped(docs, ranks_path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shipped.value
        for batch in batches:
            ids = [own.encode(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=[id_col, "ids"]
            )

    kept = docs.select(f"`{id_col}`", f"`{text_col}`")
    return kept.mapInArrow(run, f"`{id_col}` {kept.dtypes[0][1]}, ids array<int>")


def decode(encoded: DataFrame, ranks_path: str, pattern: str, *, id_col: str = "doc_id") -> DataFrame:
    """(id, bytes binary): the inverse of ``encode``."""
    shipped = _shipped(encoded, ranks_path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shipped.value
        for batch in batches:
            texts = [own.decode(i or ()) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.binary())], names=[id_col, "bytes"]
            )

    kept = encoded.select(f"`{id_col}`", "ids")
    return kept.mapInArrow(run, f"`{id_col}` {kept.dtypes[0][1]}, bytes binary")


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, *, with_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, and ids if asked): encode, decode the ids, digest both."""
    shipped = _shipped(docs, ranks_path, pattern)
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shipped.value
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                counts, ids_sha, bytes_sha, all_ids = [], [], [], []
                for text in batch.column(1):
                    ids = own.encode(text.as_py())
                    counts.append(len(ids))
                    joined = " ".join(map(own.decimal.__getitem__, ids))
                    ids_sha.append(hashlib.sha256(joined.encode()).hexdigest())
                    bytes_sha.append(hashlib.sha256(own.decode(ids)).hexdigest())
                    if with_ids:
                        all_ids.append(ids)
                columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha), pa.array(bytes_sha)]
                if with_ids:
                    columns.append(pa.array(all_ids, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kept = docs.select("doc_id", "text")
    return kept.mapInArrow(
        run,
        f"doc_id {kept.dtypes[0][1]}, n_tokens long, ids_sha256 string, decoded_sha256 string"
        + ", ids array<int>" * with_ids,
    )
