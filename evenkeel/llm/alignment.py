"""Which tokens of two tokenizers cover the same bytes, with corpus-wide counts of the pairs.

Both tokenizers encode a blank and the text. Bytes where tokens of both end cut them into groups; every two
tokens whose bytes overlap are a link. A pair of ids counts the documents that hold it linked.

Counting spills: a task gathers (pair, document) records until a run is full, sorts them by radix, A id and B
id, and packs them with zstandard. A run holds each of its pairs once with the number of its documents (the
heads, one row per radix), and the documents and times of every pair (one row). Only heads are shuffled, so a
pair that every document holds costs one record per run. The heads of a radix are merged by a heap; as they
come A id by A id, the highest count of an id is known when its last pair is merged. Counts go back to the
runs, which add them up per document. A merge opens at most ``FAN_IN`` runs: more are merged in levels, and
the counts are handed down the same way.

Texts are cut before blanks that follow no white space; no entry of either tokenizer reaches over such a
place, which is checked on the vocabulary. So pieces are tokenized and aligned once and remembered.

Defined results: NULL, empty and unfaithfully tokenized texts have zeros and an empty digest; texts of any
length are whole; every row is a document of its own, also one of a repeated or NULL id; an empty table gives
an empty table; columns besides the id and the text are not looked at.
"""

from __future__ import annotations

import heapq
import os
import re
from array import array
from collections import ChainMap
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import cut, stored

#: Links after which a run is packed, and runs a merge opens at once.
RUN_LINKS = 1 << 21
FAN_IN = 64
#: Parts of the A ids, by their remainder: frequent ids have neighbouring numbers.
RADIX = 64
#: Documents of a run take this many bits of a record.
_DOC_BITS = 20
#: Pieces of text remembered by a Python worker, and the greatest length of one.
REMEMBERED = 250_000
LONG = 64
_PIECES = re.compile(r" *[^ ]+(?:(?<=\s) +[^ ]*)*| +")
_BLOCK = 4096
_PORTION = 512


def _byte_level() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable ones stand for themselves."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class Aligner:
    """Links and groups of texts under a byte-level tokenizer (A) and a sentencepiece model (B)."""

    def __init__(self, a_file: str, b_model: bytes) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks fill the cores
        self.a = Tokenizer.from_str(a_file)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        octets = _byte_level()
        size = self.a.get_vocab_size(with_added_tokens=True)
        self.a_bytes = [bytes(octets[c] for c in self.a.id_to_token(i)) if all(c in octets for c in self.a.id_to_token(i)) else b"" for i in range(size)]
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        self.b_size = self.b.get_piece_size()
        pieces = self.b.id_to_piece(list(range(self.b_size)))
        self.b_bytes = [
            bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        faithful = "x  y " == "".join(self.b.id_to_piece(self.b.encode("x  y "))).replace("▁", " ")[1:]
        if not faithful or any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("the second tokenizer joins words or drops blanks")
        #: Codes order pairs by radix, A id and B id: the table has an A id's part of them.
        self.width = -(-size // RADIX)
        if RADIX * self.width * self.b_size >= 1 << (63 - _DOC_BITS):
            raise ValueError("the vocabularies are too large")
        ids = np.arange(size)
        self.base = (ids % RADIX * self.width + ids // RADIX) * self.b_size
        self.a_length, self.b_length = (np.array([len(t) for t in x]) for x in (self.a_bytes, self.b_bytes))
        #: What the digest reads for a token inside and at the end of its group, A before B.
        self.spelled = np.array(
            [b"%d%c" % (i, c) for n, last in ((size, b"|"), (self.b_size, b";")) for i in range(n) for c in b"," + last], object
        )
        #: Ids of A and of B by piece, and the pieces whose bytes one of them changes.
        self.known_a: dict[str, bytes] = {}
        self.known_b: dict[str, bytes] = {}
        self.unfaithful: set[str] = set()

    def _b_ids(self, pieces: list[str]) -> list[list[int]]:
        """Pieces start with a blank, which the model adds by itself to what is not empty."""
        found = self.b.encode([p[1:] for p in pieces], out_type=int, num_threads=1)
        for k, piece in enumerate(pieces):
            if piece == " ":
                found[k] = self.b.encode("x ")[len(self.b.encode("x")) :]
        return found

    def _learn(self, new: list[str], known_a: dict[str, bytes], known_b: dict[str, bytes]) -> None:
        for at in range(0, len(new), _BLOCK):
            part = new[at : at + _BLOCK]
            a_ids = [e.ids for e in self.a.encode_batch_fast(part, add_special_tokens=False)]
            b_ids = self._b_ids(part)
            known_a.update(zip(part, [array("i", i).tobytes() for i in a_ids], strict=True))
            known_b.update(zip(part, [array("i", i).tobytes() for i in b_ids], strict=True))
            flat, stops = "".join(part).encode(), np.cumsum([len(p.encode()) for p in part])
            if not (self._spells(flat, stops, a_ids, self.a_bytes) and self._spells(flat, stops, b_ids, self.b_bytes)):
                self.unfaithful.update(
                    p for p, a, b in zip(part, a_ids, b_ids, strict=True)
                    if not p.encode() == b"".join([self.a_bytes[i] for i in a]) == b"".join([self.b_bytes[i] for i in b])
                )

    @staticmethod
    def _spells(flat: bytes, stops: np.ndarray, ids: list[list[int]], spelling: list[bytes]) -> bool:
        """Whether the ids spell the bytes and end where the pieces end."""
        parts = list(map(spelling.__getitem__, chain.from_iterable(ids)))
        ends = np.append(0, np.cumsum(list(map(len, parts))))[np.cumsum(list(map(len, ids)))]
        return b"".join(parts) == flat and bool((ends == stops).all())

    def _encoded(self, texts: list[str | None]) -> list[tuple[bytes, bytes]]:
        """Ids of A and B for each text."""
        pieces = [_PIECES.findall(" " + t) if t else [] for t in texts]
        wanted = set(chain.from_iterable(pieces))
        new = wanted - self.known_a.keys()
        if len(self.known_a) + len(new) > REMEMBERED:
            self.known_a.clear()
            self.known_b.clear()
            self.unfaithful.clear()
            new = wanted
        self._learn([p for p in new if len(p) <= LONG], self.known_a, self.known_b)
        a_of, b_of = self.known_a, self.known_b
        if long := [p for p in new if len(p) > LONG]:
            long_a, long_b = {}, {}
            self._learn(long, long_a, long_b)
            a_of, b_of = ChainMap(long_a, a_of), ChainMap(long_b, b_of)
        unfaithful = self.unfaithful & wanted
        out = []
        for own in pieces:
            whole = unfaithful.isdisjoint(own)
            out.append((b"".join(map(a_of.__getitem__, own)), b"".join(map(b_of.__getitem__, own))) if whole else (b"", b""))
        self.unfaithful.difference_update(long)
        return out

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """(tokens of A, of B, groups, links of each text; codes of all links; digests of the groups)."""
        ids = self._encoded(texts)
        a, b = (np.frombuffer(b"".join(part), "<i4") for part in zip(*ids, strict=True))
        n_a, n_b = (np.array([len(i[k]) // 4 for i in ids]) for k in (0, 1))
        stop_a, stop_b = np.cumsum(n_a), np.cumsum(n_b)
        end_a, end_b = np.cumsum(self.a_length[a]), np.cumsum(self.b_length[b])
        # Bit 0: a token of A ends behind this byte, bit 1: one of B does. Every end closes one link.
        marks = np.zeros(end_a[-1] if len(a) else 0, np.uint8)
        marks[end_a - 1] = 1
        marks[end_b - 1] += 2
        ends = np.flatnonzero(marks)
        kind = marks[ends]
        link_a, link_b = (np.cumsum(bit) - bit for bit in (kind & 1, kind >> 1))
        codes = self.base[a[link_a]] + b[link_b]
        last_a, last_b = marks[end_a - 1] == 3, marks[end_b - 1] == 3
        closed_a, closed_b = np.flatnonzero(last_a) + 1, np.flatnonzero(last_b) + 1
        # The digest's order: a group's tokens of A, then its tokens of B.
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + np.append(0, closed_b)[np.cumsum(last_a) - last_a]] = 2 * a + last_a
        order[np.arange(len(b)) + closed_a[np.cumsum(last_b) - last_b]] = 2 * (len(self.base) + b) + last_b
        stops = np.append(0, stop_a + stop_b).tolist()
        spelled = self.spelled[order]
        digests = [
            sha256(b"".join(spelled[lo:hi].tolist())[:-1]).hexdigest() if lo < hi else ""
            for lo, hi in zip(stops, stops[1:], strict=False)
        ]
        bytes_before = np.append(0, end_a)[stop_a]
        n_links = np.diff(np.searchsorted(ends, bytes_before), prepend=0)
        n_groups = np.diff(np.append(0, np.cumsum(last_a))[stop_a], prepend=0)
        return np.stack([n_a, n_b, n_groups, n_links], axis=1), codes, digests


@lru_cache(maxsize=2)
def aligner(a_file: str, b_model: bytes) -> Aligner:
    return Aligner(a_file, b_model)


def _packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values, "<i8").tobytes())


def _unpacked(value: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(value), "<i8")


def _packed_codes(codes: np.ndarray) -> bytes:
    return _packed(np.diff(codes, prepend=0))


def _unpacked_codes(value: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(value))


_HEAD = "run long, radix int, codes binary, holders binary"
_BODY = "figures binary, digests array<string>, docs binary, times binary"
_ANSWER = "run long, radix int, totals binary, highest binary"


def _radix_rows(codes: np.ndarray, holders: np.ndarray, span: int) -> Iterator[tuple[int, bytes, bytes]]:
    digits = codes // span
    for radix in np.unique(digits).tolist():
        lo, hi = np.searchsorted(digits, [radix, radix + 1])
        yield radix, _packed_codes(codes[lo:hi]), _packed(holders[lo:hi])


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.DataType, list, list]]:
    """(type of the ids, ids, texts) of a few rows at a time, one at least."""
    for batch in batches:
        ids, texts, size = [], [], 0
        for name, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            ids.append(name)
            texts.append(text.as_py())
            size += len(texts[-1] or "")
            if size >= 1 << 20 or len(ids) == _PORTION:
                yield batch.column(0).type, ids, texts
                ids, texts, size = [], [], 0
        if ids:
            yield batch.column(0).type, ids, texts


def _runs(docs: DataFrame, make: Callable[[], Aligner], run_links: int) -> DataFrame:
    """Sorted, packed runs: a row of heads per radix, and one row (radix -1) of documents and records."""
    id_type = docs.dtypes[0][1]
    schema = f"{_HEAD}, ids array<{id_type}>, {_BODY}"
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = make()
        span, number = align.width * align.b_size, TaskContext.get().partitionId() << 32
        kind = None
        ids, figures, digests, links = [], [], [], []

        def rows() -> Iterator[pa.RecordBatch]:
            whole = np.concatenate(figures)
            of = np.repeat(np.arange(len(ids)), whole[:, 3])
            records = np.sort(np.concatenate(links) << _DOC_BITS | of)
            first = np.flatnonzero(np.diff(records, prepend=-1))
            times = np.diff(first, append=len(records))
            codes, of = records[first] >> _DOC_BITS, records[first] & (1 << _DOC_BITS) - 1
            heads = np.flatnonzero(np.diff(codes, prepend=-1))
            holders = np.diff(heads, append=len(codes))
            table = [(number, r, c, h, None, None, None, None, None) for r, c, h in _radix_rows(codes[heads], holders, span)]
            table.append((number, -1, None, _packed(holders), ids, _packed(whole.ravel()), digests, _packed(of), _packed(times)))
            types = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), kind, pa.binary(), pa.list_(pa.string()), pa.binary(), pa.binary()]
            columns = zip(*table, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        filled = 0
        for id_kind, own_ids, texts in _portions(batches):
            kind = pa.list_(id_kind)
            counts, codes, own = align(texts)
            ids += own_ids
            figures.append(counts)
            digests += own
            links.append(codes)
            filled += len(codes)
            if filled >= run_links or len(ids) >= (1 << _DOC_BITS) - _PORTION:
                yield from rows()
                number, filled = number + 1, 0
                ids, figures, digests, links = [], [], [], []
        if ids:
            yield from rows()

    return docs.mapInArrow(run, schema)


def _records(heads: pa.Table) -> list[Iterator[tuple[int, int]]]:
    """One sorted stream of (code, documents) for each run."""

    def stream(codes: np.ndarray, holders: np.ndarray) -> Iterator[tuple[int, int]]:
        for at in range(0, len(codes), _BLOCK):
            yield from zip(codes[at : at + _BLOCK].tolist(), holders[at : at + _BLOCK].tolist(), strict=True)

    return [
        stream(_unpacked_codes(c.as_py()), _unpacked(h.as_py()))
        for c, h in zip(heads["codes"], heads["holders"], strict=True)
    ]


def _merged(streams: Iterable[Iterator[tuple[int, int]]]) -> Iterator[tuple[int, int]]:
    """Every code once, with the sum of its documents."""
    for code, same in groupby(heapq.merge(*streams), key=lambda record: record[0]):
        yield code, sum(n for _, n in same)


def _sides(merged: Iterator[tuple[int, int]], b_size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, totals, whether highest): the highest total of an A id is known once its codes are through."""
    codes, totals, highest = [], [], []
    for _, side in groupby(merged, key=lambda record: record[0] // b_size):
        records = list(side)  # at most the B vocabulary
        most = max(n for _, n in records)
        codes += [c for c, _ in records]
        totals += [n for _, n in records]
        highest += [n == most for _, n in records]
    return np.array(codes, np.int64), np.array(totals, np.int64), np.array(highest, np.int64)


def _handed(heads: pa.Table, codes: np.ndarray, totals: np.ndarray, highest: np.ndarray) -> pa.Table:
    """For each run the totals of its codes, in its order."""
    where = [np.searchsorted(codes, _unpacked_codes(c.as_py())) for c in heads["codes"]]
    return pa.table({
        "run": heads["run"], "radix": heads["radix"],
        "totals": pa.array([_packed(totals[w]) for w in where], pa.binary()),
        "highest": pa.array([_packed(highest[w]) for w in where], pa.binary()),
    })


def _totals(heads: DataFrame, keep: Callable, n_runs: int, b_size: int, fan_in: int) -> DataFrame:
    """(run, radix, totals, highest): the corpus-wide count of every pair of every run."""

    def answer(group: pa.Table) -> pa.Table:
        return _handed(group, *_sides(_merged(_records(group)), b_size))

    if n_runs <= fan_in:
        return heads.groupBy("radix").applyInArrow(answer, _ANSWER)
    buckets = -(-n_runs // fan_in)
    dealt = heads.withColumn("bucket", F.pmod(F.xxhash64("run"), F.lit(buckets)))

    def merge(group: pa.Table) -> pa.Table:
        found = np.array(list(_merged(_records(group))), np.int64).reshape(-1, 2)
        return pa.table({
            "run": group["bucket"][:1], "radix": group["radix"][:1],
            "codes": pa.array([_packed_codes(found[:, 0])], pa.binary()), "holders": pa.array([_packed(found[:, 1])], pa.binary()),
        })

    def hand_down(group: pa.Table, above: pa.Table) -> pa.Table:
        codes = np.unique(np.concatenate([_unpacked_codes(c.as_py()) for c in group["codes"]]))
        return _handed(group, codes, _unpacked(above["totals"][0].as_py()), _unpacked(above["highest"][0].as_py()))

    merged = keep(dealt.groupBy("radix", "bucket").applyInArrow(merge, _HEAD))
    above = _totals(merged, keep, buckets, b_size, fan_in).withColumnRenamed("run", "bucket")
    return dealt.groupBy("radix", "bucket").cogroup(above.groupBy("radix", "bucket")).applyInArrow(hand_down, _ANSWER)


def align(
    docs: DataFrame,
    a_path: str,
    b_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    run_links: int = RUN_LINKS,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row."""
    spark = docs.sparkSession
    with open(a_path, encoding="utf-8") as file, open(b_path, "rb") as model:
        shipped = spark.sparkContext.broadcast((file.read(), model.read()))  # vocabularies, whatever the table
    b_size = sentencepiece.SentencePieceProcessor(model_proto=shipped.value[1]).get_piece_size()
    kept = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    id_type = kept.dtypes[0][1]
    figures = ["n_a", "n_b", "n_groups", "n_links"]

    def finish(body: pa.Table, answers: pa.Table) -> pa.Table:
        own = body.to_pylist()[0]
        answers = answers.sort_by("radix")
        totals, highest = (
            np.concatenate([np.empty(0, np.int64), *(_unpacked(v.as_py()) for v in answers[name])]) for name in ("totals", "highest")
        )
        holders, of, times = _unpacked(own["holders"]), _unpacked(own["docs"]), _unpacked(own["times"])
        sums, bests = np.zeros((2, len(own["ids"])), np.int64)
        np.add.at(sums, of, np.repeat(totals, holders) * times)
        np.add.at(bests, of, np.repeat(highest, holders) * times)
        columns = _unpacked(own["figures"]).reshape(-1, 4).T
        return pa.table({
            "id": body["ids"].combine_chunks().flatten(), **dict(zip(figures, map(pa.array, columns), strict=True)),
            "n_best": pa.array(bests), "count_sum": pa.array(sums), "groups_sha256": pa.array(own["digests"], pa.string()),
        })

    with stored(spark) as keep:
        runs = keep(_runs(kept, lambda: aligner(*shipped.value), run_links), few=False)
        bodies = runs.filter("radix = -1").select("run", "holders", "ids", "figures", "digests", "docs", "times")
        heads = runs.filter("radix >= 0").select("run", "radix", "codes", "holders")
        answers = _totals(heads, keep, bodies.count(), b_size, fan_in)
        schema = f"id {id_type}, " + "".join(f"{n} long, " for n in figures) + "n_best long, count_sum long, groups_sha256 string"
        found = bodies.groupBy("run").cogroup(answers.groupBy("run")).applyInArrow(finish, schema)
        return cut(found.withColumnRenamed("id", id_col))
