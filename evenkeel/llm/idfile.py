"""Token ids in binary files: bit planes of fixed-size id blocks, each plane packed with zstandard.

A file is a Spark table of chunks. A chunk holds whole documents, in order, as one binary value:

    magic "EKP1" | block count | per block: id count, plane count, plane sizes | the packed planes

all numbers little-endian unsigned 32-bit. Plane p of a block holds bit p of every id (bit planes) or
byte p (byte planes), so that the nearly constant high planes pack to almost nothing. Beside the value a
chunk row carries its shard, its number, its first position in the shard and the document index (ids and
starts). Spark writes and reads the table, so any store it knows will do, and a lost task is redone.

Defined results: NULL text counts as empty, so such a document holds only the end id; documents of equal
id keep one entry each, ordered by text; NULL ids come first; no documents give no chunks.
"""

from __future__ import annotations

import os
import struct
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

MAGIC = b"EKP1"
#: Ids of a block; a chunk is closed at the end of the document that fills its blocks.
BLOCK = 1 << 15
CHUNK = 1 << 18
#: Distinct words remembered by a Python worker.
REMEMBERED = 250_000
#: Separators for Python's split that the tokenizer does not count as white space.
_ODD = "\x1c\x1d\x1e\x1f"


def pack(ids: np.ndarray, *, block: int = BLOCK, bits: bool = True, level: int = 3) -> bytes:
    """Ids as one chunk value."""
    packer = zstandard.ZstdCompressor(level=level)
    index, planes = [struct.pack("<I", -(-len(ids) // block))], []
    for at in range(0, len(ids), block):
        part = np.ascontiguousarray(ids[at : at + block], dtype="<u4")
        octets = part.view(np.uint8).reshape(len(part), 4)
        used = max(1, (int(part.max()).bit_length() + 7) // 8)
        if bits:
            rows = [np.packbits(part & np.uint32(1 << p) != 0, bitorder="little") for p in range(8 * used)]
        else:
            rows = [octets[:, p] for p in range(used)]
        packed = [packer.compress(r.tobytes()) for r in rows]
        index.append(struct.pack("<II", len(part), len(packed)))
        index.append(struct.pack(f"<{len(packed)}I", *map(len, packed)))
        planes += packed
    return MAGIC + (b"\1" if bits else b"\0") + b"".join(index) + b"".join(planes)


def unpack(value: bytes) -> np.ndarray:
    """The ids of a chunk value."""
    if value[:4] != MAGIC:
        raise ValueError("not a chunk of token ids")
    bits, at = value[4] == 1, 9
    blocks = []
    for _ in range(struct.unpack_from("<I", value, 5)[0]):
        n, planes = struct.unpack_from("<II", value, at)
        blocks.append((n, struct.unpack_from(f"<{planes}I", value, at + 8)))
        at += 8 + 4 * planes
    reader = zstandard.ZstdDecompressor()
    found = [np.empty(0, np.uint32)]
    for n, sizes in blocks:
        rows = []
        for size in sizes:
            rows.append(np.frombuffer(reader.decompress(value[at : at + size]), np.uint8))
            at += size
        ids = np.zeros(n, "<u4")
        for p, row in enumerate(rows):
            if bits:
                ids |= np.unpackbits(row, count=n, bitorder="little").astype(np.uint32) << np.uint32(p)
            else:
                ids |= row.astype(np.uint32) << np.uint32(8 * p)
        found.append(ids)
    return np.concatenate(found)


#: Characters up to here have neither compositions nor contextual lower case.
_PLAIN = "\u0130"
#: ASCII marks but the apostrophe, with which a rule joins letters.
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


class Words:
    """A tokenizer that drops white space, with the ids of words it has seen.

    No rule of such a tokenizer looks across white space, so a text's ids are those of its words in turn.
    A new word of plain letters, with or without marks behind it, goes to the tokenizer's model in the
    spelling its normalizer and byte level give; others, and all if a trial of that differs, go whole.
    """

    def __init__(self, text: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks fill the cores
        self.tokenizer = Tokenizer.from_str(text)
        self.tokenizer_model = self.tokenizer.model
        self.known = _Known(self._found)
        self.stems: dict[str, bytes] = {}
        byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        letters = [c for c in map(chr, range(ord(_PLAIN))) if c.isalpha()]
        self.spelling = {ord(c): byte_level.pre_tokenize_str(c)[0][0] for c in letters}
        self.tails: dict[str, bytes] = {}
        trial = [*letters, "".join(letters), "Though", "naïveté", f"Word{_MARKS}"]
        trial += [f"{word}{m}{n}" for word in ("Word", "é") for m in _MARKS for n in ("", m, m + m, ".", "," + m)]
        self.model = self.tokenizer.model if all(self._plain(w) == self._whole([w])[0] for w in trial) else None

    def _whole(self, words: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in encoded]

    def _plain(self, word: str) -> bytes | None:
        """The ids of a word of plain letters and perhaps marks, else None."""
        tail = b""
        letters = word.rstrip(_MARKS)
        if len(letters) < len(word):
            marks = word[len(letters) :]
            tail = self.tails.get(marks)
            if tail is None:
                tail = self.tails[marks] = self._whole([marks])[0]
            word = letters
        # ASCII letters are spelled as they are.
        ascii_ = word.isascii()
        if not word.isalpha() or not (ascii_ or max(word) < _PLAIN):
            return None
        stem = word.lower()
        found = self.stems.get(stem)
        if found is None:
            spelled = stem if ascii_ else stem.translate(self.spelling)
            found = self.stems[stem] = array("I", [t.id for t in self.tokenizer_model.tokenize(spelled)]).tobytes()
        return found + tail if tail else found

    def _found(self, word: str) -> bytes:
        plain = self._plain(word) if self.model is not None else None
        return self._whole([word])[0] if plain is None else plain

    def ids(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, np.uint32)
        if any(c in text for c in _ODD):
            whole = self.tokenizer.encode(text, add_special_tokens=False)
            return np.array(whole.ids, np.uint32)
        if len(self.known) > REMEMBERED:
            self.known.clear()
        for parts in (self.stems, self.tails):
            if len(parts) > REMEMBERED:
                parts.clear()
        return np.frombuffer(b"".join(map(self.known.__getitem__, text.split())), "<u4")


class _Known(dict):
    """Ids of words, found out when a word is first asked for."""

    def __init__(self, find: Callable[[str], bytes]) -> None:
        super().__init__()
        self.find = find

    def __missing__(self, word: str) -> bytes:
        found = self[word] = self.find(word)
        return found


@lru_cache(maxsize=2)
def _words(text: str) -> Words:
    return Words(text)


def word_encoder(spark, path: str) -> Callable[[], Callable[[str | None], np.ndarray]]:
    """A factory, for tasks, of the encoder in a tokenizer file; the file is read on the driver only."""
    with open(path, encoding="utf-8") as file:
        shipped = spark.sparkContext.broadcast(file.read())
    return lambda: _words(shipped.value).ids


def write(
    docs: DataFrame,
    path: str,
    encoder: Callable[[], Callable[[str | None], np.ndarray]],
    *,
    end_id: int,
    bits: bool = True,
    block: int = BLOCK,
    chunk: int = CHUNK,
) -> None:
    """Encode every text, append the end id and write the chunks of all documents by ascending doc_id."""
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id")
    ordered = ordered.sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder()
        shard = TaskContext.get().partitionId()
        number = first = size = 0
        names, starts, parts, kind = [], [], [], None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([number], pa.int32()), pa.array([first], pa.int64()),
                 pa.array([size], pa.int64()), pa.array([names], pa.list_(kind)),
                 pa.array([starts], pa.list_(pa.int64())),
                 pa.array([pack(np.concatenate(parts), block=block, bits=bits)], pa.binary())],
                names=["shard", "chunk", "first", "n_ids", "doc_ids", "doc_starts", "planes"],
            )

        end = np.array([end_id], np.uint32)
        for batch in batches:
            kind = batch.column(0).type
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = ids_of(text.as_py())
                names.append(name)
                starts.append(size)
                parts += [ids, end]
                size += len(ids) + 1
                if size >= chunk:
                    yield row()
                    number, first, size = number + 1, first + size, 0
                    names, starts, parts = [], [], []
        if names:
            yield row()

    id_type = ordered.dtypes[0][1]
    chunks = ordered.mapInArrow(
        run,
        f"shard int, chunk int, first long, n_ids long, doc_ids array<{id_type}>, "
        "doc_starts array<long>, planes binary",
    )
    # The planes are packed already.
    chunks.write.option("compression", "uncompressed").parquet(path)


def read(spark, path: str) -> DataFrame:
    """The chunks with the position of their first id among all ids."""
    chunks = spark.read.parquet(path)
    # One row per shard, so at most as many rows as the writing job had tasks.
    totals = chunks.groupBy("shard").agg(F.sum("n_ids").alias("shard_ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col("shard").alias("of_shard"), F.coalesce(F.sum("shard_ids").over(before), F.lit(0)).alias("before")
    )
    joined = chunks.join(F.broadcast(offsets), F.col("shard") == F.col("of_shard"))
    return joined.select(*chunks.columns, (F.col("before") + F.col("first")).alias("start"))


def read_documents(spark, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files."""
    chunks = read(spark, path).select("doc_ids", "doc_starts", "start", "planes")
    id_type = chunks.dtypes[0][1].removeprefix("array<").removesuffix(">")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids = unpack(batch.column(3)[i].as_py()).astype("<u4")
                names = batch.column(0)[i].as_py()
                starts = np.array(batch.column(1)[i].as_py(), np.int64)
                ends = np.append(starts[1:], len(ids))
                crcs = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, batch.column(0).type.value_type), pa.array(starts + batch.column(2)[i].as_py()),
                     pa.array(ends - starts), pa.array(crcs, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return chunks.mapInArrow(run, f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long")
