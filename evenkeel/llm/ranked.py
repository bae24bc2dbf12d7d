"""Ranked lexical search over intervals of documents, bounded by range maxima of posting lists.

Documents fall into shards by where they are read. A shard numbers its documents by ascending id and holds a
posting list per term: documents and occurrences. Items are dealt into blocks; the lists of the terms that a
block asks for meet the block once per shard.

A posting's impact is what one occurrence of its term in an item is worth. Every list has a sparse table of
range maxima, so the greatest impact in any interval of documents takes two look-ups, and the sum over an
item's terms bounds every score in the interval. Intervals are taken by falling bound: the document of the
greatest single impact is scored, and the interval is cut there in two. What lies below the k-th best score
is left, so the result is exact. A wave takes the best few intervals at once.

Defined results: NULL and empty texts hold no terms and are neither counted nor found; a NULL doc_id comes
after all others and may be found; every row is a document of its own, also one of a repeated id; items of
equal id and text count once, of equal id and different texts each for itself; an empty table gives an empty
result; columns besides ids and texts are not looked at. Ids are whole numbers; texts of any length are whole.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, stored

K = 10
#: A shard is closed at so many documents or occurrences of terms.
SHARD_DOCS = 1 << 15
SHARD_TERMS = 1 << 23
#: Items of a block, and intervals taken at once.
BLOCK_ITEMS = 1024
WAVE = 128
#: Every ASCII character but digits and letters ends a term; only A to Z have another case.
_FOLDED = bytes(
    b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in (ord(chr(b).lower()) if b < 0x80 else b for b in range(256))
)
_NONE = np.iinfo(np.int64).max


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a text in UTF-8, in order."""
    return text.translate(_FOLDED).split() if text else []


_SHARD = "shard long, term string, docs array<int>, times array<int>, ids array<long>, lengths array<long>"


def shards(docs: DataFrame, shard_docs: int = SHARD_DOCS, shard_terms: int = SHARD_TERMS) -> DataFrame:
    """Per shard a row for each term (its documents by number and its occurrences) and one, of NULL term, with
    the documents' ids and counts of terms."""
    ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())
    schema = pa.schema([("shard", pa.int64()), ("term", pa.string()), ("docs", ints), ("times", ints), ("ids", longs), ("lengths", longs)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, ids, found, filled = TaskContext.get().partitionId() << 32, [], [], 0
        number: defaultdict[bytes, int] = defaultdict()
        number.default_factory = number.__len__

        def rows() -> Iterator[pa.RecordBatch]:
            names = np.array([_NONE if i is None else i for i in ids], np.int64)
            order = np.argsort(names, kind="stable")
            lengths = np.array([len(found[k]) for k in order], np.int64)
            flat = np.concatenate([found[k] for k in order]).astype(np.int64) << 32 | np.repeat(np.arange(len(ids)), lengths)
            flat.sort()
            first = np.flatnonzero(np.diff(flat, prepend=-1))
            times, of = np.diff(first, append=len(flat)).astype(np.int32), flat[first] >> 32
            starts = np.append(np.searchsorted(of, np.arange(len(number))), len(of)).astype(np.int32)
            docs = (flat[first] & 0xFFFFFFFF).astype(np.int32)
            n = len(number)
            for lo in range(0, n, 1 << 14):
                hi = min(n, lo + (1 << 14))
                cut = starts[lo : hi + 1] - starts[lo]
                values = slice(starts[lo], starts[hi])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(hi - lo, shard)), pa.array(spelled[lo:hi], pa.binary()).cast(pa.string()),
                    pa.ListArray.from_arrays(cut, docs[values]), pa.ListArray.from_arrays(cut, times[values]),
                    pa.nulls(hi - lo, longs), pa.nulls(hi - lo, longs),
                ], schema=schema)
            own = pa.array([[None if i == _NONE else i for i in names[order].tolist()]], longs)
            yield pa.RecordBatch.from_arrays([
                pa.array([shard]), pa.array([None], pa.string()), pa.array([None], ints), pa.array([None], ints), own,
                pa.array([lengths], longs),
            ], schema=schema)

        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = terms(text.as_py())
                if not own:
                    continue
                ids.append(name)
                found.append(np.fromiter(map(number.__getitem__, own), np.int32, len(own)))
                filled += len(own)
                if filled >= shard_terms or len(ids) == shard_docs:
                    spelled = list(number)
                    yield from rows()
                    number.clear()
                    shard, ids, found, filled = shard + 1, [], [], 0
        if ids:
            spelled = list(number)
            yield from rows()

    return docs.mapInArrow(run, _SHARD)


class Lists:
    """The posting lists of a shard end to end, with one sparse table of the places of range maxima."""

    def __init__(self, docs: list[np.ndarray], impacts: list[np.ndarray]) -> None:
        sizes = [len(d) for d in docs]
        self.start = np.cumsum([0, *sizes])
        self.doc = np.concatenate([np.empty(0, np.int64), *docs])
        #: Sorted over all lists, so that one search finds a document's place in any list.
        self.key = np.repeat(np.arange(len(docs)), sizes) << 32 | self.doc
        self.impact = np.concatenate([np.empty(0, np.int64), *impacts])
        self.tables = [np.arange(len(self.doc), dtype=np.int32)]
        for level in range(max(sizes, default=1).bit_length() - 1):
            low, half = self.tables[-1], 1 << level
            a, b = low[:-half], low[half:]
            self.tables.append(np.where(self.impact[a] >= self.impact[b], a, b))
        # Tables of all levels in one array, for look-ups of mixed levels.
        self.level_at = np.cumsum([0, *(len(t) for t in self.tables)])
        self.table = np.concatenate(self.tables)
        del self.tables

    def greatest(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, impact) of the maximum between the places; impact 0 where there are none."""
        size = hi - lo
        some = size > 0
        level = np.frexp(np.maximum(size, 1))[1] - 1
        at = self.level_at[level]
        a = self.table[at + np.where(some, lo, 0)]
        b = self.table[at + np.where(some, hi - (1 << level), 0)]
        ia, ib = self.impact[a], self.impact[b]
        return np.where(ia >= ib, a, b), np.where(some, np.maximum(ia, ib), 0)


def best(lists: Lists, chosen: np.ndarray, factor: np.ndarray, ids: np.ndarray, k: int = K, wave: int = WAVE) -> list[tuple[int, int]]:
    """(score, document number) of the k best documents for the chosen lists, each worth its factor."""
    top: list[tuple[int, int]] = []  # by falling score, then rising number, which rises with the id

    def bounded(lo, hi, first, end):
        """Intervals with their bound and the document to cut at; those that can't matter are left out."""
        place, impact = lists.greatest(lo, hi)
        worth = impact * factor
        bound = worth.sum(1)
        at = lists.doc[place[np.arange(len(worth)), worth.argmax(1)]]
        live = bound > 0
        if len(top) == k:
            live &= (bound > top[-1][0]) | ((bound == top[-1][0]) & (ids[first] < ids[top[-1][1]]))
        return lo[live], hi[live], first[live], end[live], bound[live], at[live]

    n = len(ids)
    pool = bounded(lists.start[chosen][None], lists.start[chosen + 1][None], np.array([0]), np.array([n]))
    while len(pool[0]):
        if len(pool[0]) > wave:
            order = np.argpartition(-pool[4], wave)
            now, rest = order[:wave], order[wave:]
        else:
            now, rest = slice(None), slice(0, 0)
        lo, hi, first, end, _, at = (part[now] for part in pool)
        left = tuple(part[rest] for part in pool)
        # Every list's first place at or behind the document, in one search.
        place = np.searchsorted(lists.key, (chosen << 32) + at[:, None])
        held = place < hi
        held &= lists.doc[np.where(held, place, 0)] == at[:, None]
        scores = (np.where(held, lists.impact[np.where(held, place, 0)], 0) * factor).sum(1)
        top = sorted([*top, *((int(s), int(d)) for s, d in zip(scores, at, strict=True))], key=lambda f: (-f[0], f[1]))[:k]
        new = bounded(
            np.concatenate([lo, place + held]), np.concatenate([place, hi]),
            np.concatenate([first, at + 1]).clip(max=n - 1), np.concatenate([at, end]),
        )
        pool = tuple(np.concatenate(parts) for parts in zip(left, new, strict=True))
        if len(top) == k and len(left[0]):
            live = (pool[4] > top[-1][0]) | ((pool[4] == top[-1][0]) & (ids[pool[2]] < ids[top[-1][1]]))
            pool = tuple(part[live] for part in pool)
    return top


def _items(items: DataFrame, item_col: str, text_col: str) -> tuple[DataFrame, int]:
    """(item, digest, block, terms, times) of every different item that has terms, and the number of blocks."""
    text = F.col(f"`{text_col}`")
    kept = items.select(F.col(f"`{item_col}`").alias("item"), F.sha2(text, 256).alias("digest"), text.cast("binary").alias("text"))
    kept = kept.filter(F.col("text").isNotNull()).dropDuplicates(["item", "digest"])
    blocks = max(1, -(-kept.count() // BLOCK_ITEMS))
    kept = kept.withColumn("block", F.pmod(F.xxhash64("item", "digest"), F.lit(blocks)).cast("int"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [Counter(terms(t.as_py())) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item"), batch.column("digest"), batch.column("block"),
                 pa.array([[t.decode() for t in c] for c in counts], pa.list_(pa.string())),
                 pa.array([list(c.values()) for c in counts], pa.list_(pa.int64()))],
                names=["item", "digest", "block", "terms", "times"],
            )

    schema = f"item {kept.dtypes[0][1]}, digest string, block int, terms array<string>, times array<long>"
    return kept.mapInArrow(run, schema).filter(F.size("terms") > 0), blocks


def search(
    docs: DataFrame,
    items: DataFrame,
    *,
    k: int = K,
    id_col: str = "doc_id",
    item_col: str = "item_id",
    text_col: str = "text",
    shard_docs: int = SHARD_DOCS,
    shard_terms: int = SHARD_TERMS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of every item that has any."""
    spark = docs.sparkSession
    asked, blocks = _items(items, item_col, text_col)
    item_type = asked.dtypes[0][1]
    corpus = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    with stored(spark) as keep:
        asked = keep(asked)
        wanted = asked.select("block", F.explode("terms").alias("term")).groupBy("term").agg(F.collect_set("block").alias("blocks"))
        index = shards(corpus, shard_docs, shard_terms)
        # Spark broadcasts the items' terms if they are few, else it deals both sides by term.
        lists = keep(index.join(wanted, "term", "left").filter("term is null or blocks is not null"), few=False)
        rows, lists = lists.filter("term is null").selectExpr("shard at", "ids", "lengths"), lists.filter("term is not null")
        n, total = rows.select(
            F.sum(F.size("ids").cast("long")), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda t, x: t + x))
        ).first()
        held = lists.groupBy("term").agg(F.sum(F.size("docs").cast("long")).alias("df"))
        lists = lists.join(held, "term").select("shard", F.explode("blocks").alias("block"), "term", "docs", "times", "df")
        # A stated query set against all rows, in blocks: every block of items meets every shard once.
        packed = asked.groupBy("block").agg(F.collect_list(F.struct("item", "digest", "terms", "times")).alias("items"))
        rows = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).join(packed, "block")
        schema = f"item {item_type}, digest string, doc_id long, score long"

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            out: list[tuple] = []
            if left.num_rows and right.num_rows:
                names = right["ids"][0].values.to_numpy(zero_copy_only=False) if not right["ids"][0].values.null_count else None
                own = right["ids"][0].as_py() if names is None else names.tolist()
                ids = np.array([_NONE if i is None else i for i in own], np.int64)
                m = 25 + 75 * right["lengths"][0].values.to_numpy() * n // total
                spelled = left["term"].to_pylist()
                places = [d.values.to_numpy().astype(np.int64) for d in left["docs"]]
                times = [t.values.to_numpy().astype(np.int64) for t in left["times"]]
                impacts = [1_000_000_000 * t // (1000 * t + 8 * m[d]) for d, t in zip(places, times, strict=True)]
                tables = Lists(places, impacts)
                number = {t: i for i, t in enumerate(spelled)}
                weight = [math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) for df in left["df"].to_pylist()]
                for item in right["items"][0].as_py():
                    pairs = [(number[t], weight[number[t]] * x) for t, x in zip(item["terms"], item["times"], strict=True) if t in number]
                    if pairs:
                        chosen, factor = np.array(pairs, np.int64).T
                        found = best(tables, chosen, factor, ids, k)
                        out += [(item["item"], item["digest"], own[d], score) for score, d in found if score > 0]
            columns = zip(*out, strict=True) if out else [[]] * 4
            types = [right.schema.field("items").type.value_type.field("item").type, pa.string(), pa.int64(), pa.int64()]
            return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["item", "digest", "doc_id", "score"])

        found = lists.groupBy("shard", "block").cogroup(rows.groupBy("at", "block")).applyInArrow(run, schema)
        order = Window.partitionBy("item", "digest").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        return cut(ranked.select(F.col("item").alias(item_col), F.col("rank").cast("int").alias("rank"), F.col("doc_id").alias(id_col), "score"))


def oracle(k: int = K) -> str:
    """DuckDB SQL: every posting of every item's terms, summed."""
    return f"""
with words as (
  select d.rowid_ r, d.doc_id, t.w from (select row_number() over () rowid_, doc_id, text from documents) d,
    lateral (select unnest(regexp_extract_all(translate(d.text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) w) t
), postings as (select r, doc_id, w, count(*) tf from words group by all),
size as (select r, count(*) n from words group by r),
total as (select count(*)::bigint n_docs, sum(n)::bigint n_terms from size),
weight as (
  select w, floor(1000 * ln((2 * n_docs + 2)::double / (2 * df + 1)::double))::bigint weight
  from (select w, count(*) df from postings group by w), total
), asked as (
  select item_id, w, count(*) q from (
    select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) w from (select distinct item_id, text from benchmark)) group by all
), scored as (
  select item_id, r, any_value(doc_id) doc_id,
    sum(q * weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))))::bigint score
  from asked join weight using (w) join postings using (w) join size using (r), total
  group by item_id, r
)
select item_id, rank::int rank, doc_id, score from (
  select item_id, doc_id, score, row_number() over (partition by item_id order by score desc, doc_id) rank
  from scored where score > 0
) where rank <= {k}
"""
