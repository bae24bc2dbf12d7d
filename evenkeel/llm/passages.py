"""Remove repeated passages: every byte of a string of ``width`` bytes that also starts earlier.

Windows of ``width`` bytes are routed by their least k-mer hash, which equal windows share. Neighbouring
windows of one least hash form a context: the bytes that hold them all. Equal contexts are combined inside
each task and again after one shuffle by key and content; all but the first are repeats as a whole. What
is left are different contexts under one key, which may share some windows: those are gathered in buckets
of keys, and a suffix array of each bucket (``suffixes``: linear grouping by Lyndon prefixes) finds which
windows an earlier one equals. A key with very many different contexts is not gathered: its windows are
hashed one by one and their first starts found by aggregation, which splits at any size.

Earlier means a smaller doc_id or, in the same document, a lesser start; windows never cross documents.

Defined results: NULL text counts as empty; a text shorter than the width keeps all; a NULL id comes before
every other; different texts of one id are texts of their own, in the order of the texts; rows of equal id and
text are one text and get equal results; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut
from .suffixes import mixed, repeats

WIDTH, KMER = 100, 40
#: Different contexts of one key that are still gathered in one task.
GATHERED = 20_000
#: Bytes of contexts that one bucket is meant to hold.
BUCKET_BYTES = 1 << 21
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
#: Stands for a NULL id inside the operator.
_NONE = -(1 << 63)


def kmer_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """A hash of each ``k`` bytes, from hashes of powers of two."""
    total, covered, found = None, 0, data.astype(np.uint64) + np.uint64(1)
    size, power = 1, _BASE
    n = len(data) - k + 1
    while True:
        if k & size:
            # Behind the part that is covered already.
            part = found[covered : covered + n]
            total = part if total is None else total * np.uint64(power) + part
            covered += size
        if 2 * size > k:
            return mixed(total)
        found = found[:-size] * np.uint64(power) + found[size:]
        size, power = 2 * size, power * power & _MASK


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def contexts(text: bytes, width: int, k: int) -> tuple[np.ndarray, ...]:
    """Least hash, start and length of every context of a text, and whether it may repeat itself.

    Equal windows of one context hold its least k-mer at different places. Then two successive places of
    least k-mers have equal hashes, and the contexts of windows that hold both are marked."""
    hashes, reach = kmer_hashes(np.frombuffer(text, np.uint8), k), width - k + 1
    least = sliding_min(hashes, reach)
    starts = np.append(0, np.flatnonzero(np.diff(least)) + 1)
    stops = np.append(starts[1:], len(least))
    loops = np.zeros(len(starts) + 1, np.int64)
    # A k-mer is least in some window if the greatest least value around it is its own.
    padded = np.concatenate([np.zeros(reach - 1, np.uint64), least, np.zeros(reach - 1, np.uint64)])
    places = np.flatnonzero(~sliding_min(~padded, reach) == hashes)
    twice = np.flatnonzero((hashes[places[1:]] == hashes[places[:-1]]) & (np.diff(places) < reach))
    if len(twice):
        last = len(least) - 1
        from_ = np.searchsorted(starts, np.clip(places[twice + 1] - reach + 1, 0, last), "right") - 1
        to = np.searchsorted(starts, np.clip(places[twice], 0, last), "right") - 1
        np.add.at(loops, from_, 1)
        np.add.at(loops, to + 1, -1)
    return least[starts].view(np.int64), starts, stops - starts + width - 1, np.cumsum(loops)[:-1] > 0


def _located(docs: DataFrame, width: int, k: int) -> DataFrame:
    """(doc, s, n, key, ctx, mark): the contexts of all texts.

    Marks: 1 may repeat itself, 2 repeats one of this task. The latter are settled and only pass through
    the shuffle, each under a key of its own, so that no key gathers them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = (text.as_py() or "").encode()
                if len(raw) < width:
                    continue
                key, s, n, loops = contexts(raw, width, k)
                digest = xxhash.xxh64_intdigest
                ctx = [digest(raw[a:b]) for a, b in zip(s.tolist(), (s + n).tolist(), strict=True)]
                ctx = np.array(ctx, np.uint64).view(np.int64)
                rows.append((np.full(len(s), doc, np.int64), s, n, key, ctx, loops))
            if not rows:
                continue
            doc, s, n, key, ctx, loops = (np.concatenate(x) for x in zip(*rows, strict=True))
            order = np.lexsort((s, doc, ctx))
            again = np.zeros(len(s), bool)
            again[order[1:]] = ctx[order[1:]] == ctx[order[:-1]]
            own = mixed(mixed(doc.view(np.uint64)) + s.astype(np.uint64)).view(np.int64)
            key, mark = np.where(again, own, key), np.where(again, 2, loops).astype(np.int8)
            # Settled contexts of a text that touch are one span.
            doc, s, n, key, ctx, mark = (
                np.concatenate([x[~again], y])
                for x, y in zip((doc, s, n, key, ctx, mark), _spans(*(x[again] for x in (doc, s, n, key, ctx, mark))), strict=True)
            )
            for a in range(0, len(s), 200_000):
                b = a + 200_000
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x[a:b]) for x in (doc, s, n, key, ctx, mark)],
                    names=["doc", "s", "n", "key", "ctx", "mark"],
                )

    return docs.mapInArrow(run, "doc long, s long, n long, key long, ctx long, mark byte")


def _spans(doc: np.ndarray, s: np.ndarray, n: np.ndarray, *rest: np.ndarray) -> tuple[np.ndarray, ...]:
    """The rows with spans of a document that overlap or touch made one; the rest is that of its first."""
    order = np.lexsort((s, doc))
    doc, s, n, *rest = (x[order] for x in (doc, s, n, *rest))
    if not len(doc):
        return doc, s, n, *rest
    # Documents laid behind one another, so that the furthest end so far is that of the same document.
    base = np.cumsum(np.append(0, doc[1:] != doc[:-1])) << 40
    reach = np.maximum.accumulate(base + s + n)
    first = np.flatnonzero(np.append(True, (base + s)[1:] > reach[:-1]))
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], s[first], (reach[last] - base[last]) - s[first], *(x[first] for x in rest)


def _compared(located: DataFrame) -> DataFrame:
    """(doc, s, n, key, first): repeats of an equal context, and first ones that may share a window.

    Those are contexts whose key has others too, and such as may repeat themselves."""
    dealt = located.repartition("key").sortWithinPartitions("key", "ctx", "doc", "s")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Of the rows before, the last (key, ctx); and the first row of its key while nothing differs.
        last_key = last_ctx = alone = None
        for batch in batches:
            doc, s, n, key, ctx, mark = (c.to_numpy() for c in batch.columns)
            if not len(key):
                continue
            new_key = np.append(last_key is None or key[0] != last_key, key[1:] != key[:-1])
            new_ctx = new_key | np.append(last_ctx is None or ctx[0] != last_ctx, ctx[1:] != ctx[:-1])
            firsts = np.flatnonzero(new_ctx)
            # A first row counts if a further first row of its key precedes or follows it.
            follows = np.append(~new_key[firsts[1:]], False)
            counts = ~new_key[firsts] | follows | (mark[firsts] == 1)
            out = np.zeros(len(key), np.int8)
            out[~new_ctx] = 1
            out[firsts[counts]] = 2
            out[mark == 2] = 1
            if alone is not None and len(firsts) and not new_key[firsts[0]]:
                yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*alone, True)], names=names)
                alone = None
            if len(firsts):
                tail = firsts[-1]
                if new_key[tail] and not mark[tail]:
                    alone = (int(doc[tail]), int(s[tail]), int(n[tail]), int(key[tail]))
                else:
                    alone = None
            last_key, last_ctx = key[-1], ctx[-1]
            rows = np.flatnonzero(out)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[rows]) for x in (doc, s, n, key)] + [pa.array(out[rows] == 2)], names=names
            )

    names = ["doc", "s", "n", "key", "first"]
    return dealt.mapInArrow(run, "doc long, s long, n long, key long, first boolean")


def _fetched(firsts: DataFrame, docs: DataFrame) -> DataFrame:
    """(key, crowded, doc, s, bytes): the bytes of contexts."""
    wanted = firsts.groupBy("doc").agg(F.collect_list(F.struct("s", "n", "key", "crowded")).alias("wanted"))
    joined = docs.join(wanted, "doc").select("doc", "text", "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                raw, wanted = batch.column(1)[k].as_py().encode(), batch.column(2)[k].values
                s, n, key, crowded = (wanted.field(i).to_numpy(zero_copy_only=False) for i in range(4))
                found = [raw[a : a + b] for a, b in zip(s.tolist(), n.tolist(), strict=True)]
                doc = np.full(len(found), batch.column(0)[k].as_py(), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(crowded), pa.array(doc), pa.array(s), pa.array(found, pa.binary())],
                    names=["key", "crowded", "doc", "s", "bytes"],
                )

    return joined.mapInArrow(run, "key long, crowded boolean, doc long, s long, bytes binary")


def _by_suffix_array(found: DataFrame, buckets: int, width: int) -> DataFrame:
    """(doc, s, n): repeats among contexts of one key, by a suffix array of each bucket."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by([("doc", "ascending"), ("s", "ascending")])
        docs, starts = table["doc"].to_numpy(), table["s"].to_numpy()
        out = []
        for k, again in enumerate(repeats(table["bytes"].to_pylist(), width)):
            edges = np.flatnonzero(np.diff(np.concatenate([[0], again.view(np.int8), [0]])))
            for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
                out.append((docs[k], starts[k] + a, b - a + width - 1))
        columns = list(zip(*out, strict=True)) or [(), (), ()]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("doc", "s", "n"), columns, strict=True)})

    bucket = F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int").alias("bucket")
    return found.select(bucket, "doc", "s", "bytes").groupBy("bucket").applyInArrow(run, "doc long, s long, n long")


def _one_by_one(found: DataFrame, width: int) -> DataFrame:
    """(doc, s, n): repeats among the windows of crowded keys, by a hash of each window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                raw, s = batch.column(2)[k].as_py(), batch.column(1)[k].as_py()
                hashes = [xxhash.xxh3_128_digest(raw[a : a + width]) for a in range(len(raw) - width + 1)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes, pa.binary()), pa.array([batch.column(0)[k].as_py()] * len(hashes), pa.int64()),
                     pa.array(range(s, s + len(hashes)), pa.int64())],
                    names=["h", "doc", "s"],
                )

    windows = cut(found.select("doc", "s", "bytes").mapInArrow(run, "h binary, doc long, s long"))
    first = windows.groupBy("h").agg(F.min(F.struct("doc", "s")).alias("first"), F.count("*").alias("c"))
    first = cut(first.filter("c > 1").select("h", "first"))
    again = windows.join(first, "h").filter(F.struct("doc", "s") != F.col("first"))
    return again.select("doc", "s", F.lit(width).cast("long").alias("n"))


def repeated_spans(docs: DataFrame, *, width: int = WIDTH, k: int = KMER, gathered: int = GATHERED) -> DataFrame:
    """(doc, s, n): byte spans of the texts (doc, text) that start earlier; spans may overlap."""
    compared = cut(_compared(_located(docs, width, k)))
    firsts = compared.filter("first")
    crowded = firsts.groupBy("key").count().filter(F.col("count") > gathered).select("key", F.lit(True).alias("crowded"))
    total = firsts.agg(F.sum("n")).first()[0] or 0
    crowded = cut(crowded)
    any_crowded = not crowded.isEmpty()
    if any_crowded:
        firsts = firsts.join(crowded, "key", "left").withColumn("crowded", F.coalesce("crowded", F.lit(False)))
    else:
        firsts = firsts.withColumn("crowded", F.lit(False))
    found = _fetched(firsts.select("doc", "s", "n", "key", "crowded"), docs)
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(4 * partitions, total // BUCKET_BYTES)
    if any_crowded:
        found = cut(found)
    spans = compared.filter("not first").select("doc", "s", "n")
    spans = spans.unionByName(_by_suffix_array(found.filter("not crowded"), buckets, width))
    if any_crowded:
        spans = spans.unionByName(_one_by_one(found.filter("crowded"), width))
    return spans


def merged(starts: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs (start, end) covered by spans."""
    runs: list[list[int]] = []
    for a, n in sorted(zip(starts.tolist(), sizes.tolist(), strict=True)):
        if runs and a <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], a + n)
        else:
            runs.append([a, a + n])
    return [(a, b) for a, b in runs]


def remove(docs: DataFrame, **settings) -> DataFrame:
    """(doc_id, n_bytes, runs, kept): the maximal removed runs [start, end) and the bytes that stay."""
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NONE).cast("long"))
    rows = docs.select("doc_id", doc.alias("doc"), F.coalesce("text", F.lit("")).alias("text"))
    examined = rows.select("doc", "text")
    if not examined.groupBy("doc").count().filter("count > 1").isEmpty():
        # Numbers that grow with id and text stand for the texts; they hold once the rows are stored.
        known = F.md5("text").alias("known")
        apart = examined.select("doc", "text", known).dropDuplicates(["doc", "known"])
        apart = apart.repartitionByRange("doc", "text").sortWithinPartitions("doc", "text")
        apart = cut(apart.withColumn("number", F.monotonically_increasing_id()))
        examined = apart.select(F.col("number").alias("doc"), "text")
        rows = rows.withColumn("known", known).join(apart.select("doc", "known", "number"), ["doc", "known"])
        rows = rows.select("doc_id", F.col("number").alias("doc"), "text")
    spans = repeated_spans(examined, **settings).groupBy("doc").agg(F.collect_list(F.struct("s", "n")).alias("spans"))
    joined = rows.join(spans, "doc", "left")
    kept = joined.select("doc_id", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                sizes, runs, rest = [], [], []
                for k in range(part.num_rows):
                    raw, spans = part.column(1)[k].as_py().encode(), part.column(2)[k]
                    own = []
                    if spans.is_valid:
                        own = merged(*(spans.values.field(i).to_numpy(zero_copy_only=False) for i in range(2)))
                    stops = [0, *(b for _, b in own)]
                    pieces = [raw[p:q] for p, q in zip(stops, [*(a for a, _ in own), len(raw)], strict=True)]
                    sizes.append(len(raw))
                    runs.append([{"start": p, "end": q} for p, q in own])
                    rest.append(b"".join(pieces))
                kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes, pa.int64()), pa.array(runs, kind), pa.array(rest, pa.binary())],
                    names=["doc_id", "n_bytes", "runs", "kept"],
                )

    return kept.mapInArrow(
        run, f"doc_id {kept.dtypes[0][1]}, n_bytes long, runs array<struct<start:long,end:long>>, kept binary"
    )
