"""Exact top-k inner products by block-at-a-time pruning.

Vectors are integers floor(256 x). Ranges of vectors by id form blocks; a block keeps the greatest and the
least value of every dimension and a forward index, its rows as one matrix. For a query, the sum over the
dimensions of the greater product bounds every score in a block. Blocks are visited by falling bound until
it is below the k-th best score, so the result is exact and ties are kept.

Rows are cut into spans of a fixed number of vectors (some blocks each) and queries into groups of a fixed
number; one task meets one bucket of spans and one group, and a query's best of all buckets are merged.
Nothing is broadcast, and a task holds a bounded number of vectors whatever the table's size.

Defined results: NULL vectors and such with NULL, NaN or infinite components neither ask nor answer;
vectors meet only vectors of their length; of rows with the same id the least vector counts, and no row
answers a query of its own id; values beyond 2 ** 62 and scores beyond a long are clipped to that range;
fewer than k other rows give as many ranks; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

BLOCK_ROWS = 256
SPAN_ROWS = 8192
GROUP_QUERIES = 4096
_LIMIT = 2.0**62
_SPAN = "place long, dim int, ids binary, vectors binary"


def _usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    v = F.col(f"`{vec_col}`")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    found = vectors.filter(F.col(f"`{id_col}`").isNotNull() & v.isNotNull() & ~F.coalesce(bad, F.lit(False)))
    return found.select(F.col(f"`{id_col}`").cast("long").alias("id"), v.cast("array<double>").alias("v"), F.size(v).alias("dim"))


def _packed(rows: DataFrame, size: int) -> DataFrame:
    """Rows by (dim, id), up to ``size`` in one binary row: ids and floor(256 x) as little-endian longs."""
    ordered = rows.repartitionByRange("dim", "id").sortWithinPartitions("dim", "id", "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId() << 32
        dim, last, ids, parts = None, None, [], []

        def row() -> pa.RecordBatch:
            values = np.concatenate(parts) if parts else np.empty(0)
            whole = np.clip(np.floor(values * 256), -_LIMIT, _LIMIT).astype("<i8")
            return pa.RecordBatch.from_arrays(
                [pa.array([place], pa.int64()), pa.array([dim], pa.int32()),
                 pa.array([np.array(ids, "<i8").tobytes()], pa.binary()), pa.array([whole.tobytes()], pa.binary())],
                names=["place", "dim", "ids", "vectors"],
            )

        for batch in batches:
            own, vectors, dims = batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()
            for k, (name, d) in enumerate(zip(own, dims, strict=True)):
                if (d, name) == (dim, last):
                    continue  # the same id again
                if ids and (d != dim or len(ids) == size):
                    yield row()
                    place, ids, parts = place + 1, [], []
                dim, last = d, name
                ids.append(name)
                parts.append(vectors[k].values.to_numpy(zero_copy_only=False))
        if ids:
            yield row()

    return ordered.mapInArrow(run, _SPAN)


def _unpacked(table: pa.Table, k: int) -> tuple[int, np.ndarray, np.ndarray]:
    dim = table["dim"][k].as_py()
    ids = np.frombuffer(table["ids"][k].as_py(), "<i8")
    return dim, ids, np.frombuffer(table["vectors"][k].as_py(), "<i8").reshape(len(ids), dim)


def _scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles while every sum stays below 2 ** 53, else in Python integers."""
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * max(1, rows.shape[1])
    if most < 2.0**53:
        return queries.astype(np.float64) @ rows.T.astype(np.float64)
    exact = queries.astype(object) @ rows.T.astype(object)
    return np.clip(exact, -(2**63), 2**63 - 1)


class _Best:
    """The k best answers of each query: greater score first, then smaller id."""

    def __init__(self, n: int, k: int) -> None:
        self.k = k
        self.row, self.score, self.id = np.empty(0, np.int64), np.empty(0, object), np.empty(0, np.int64)
        self.kth: np.ndarray = np.full(n, -np.inf, object)

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        self.row = np.concatenate([self.row, rows])
        self.score = np.concatenate([self.score, scores])
        self.id = np.concatenate([self.id, ids])
        order = np.lexsort((self.id, -self.score, self.row))
        row = self.row[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        keep = rank < self.k
        self.row, self.score, self.id = row[keep], self.score[order][keep], self.id[order][keep]
        full = rank[keep] == self.k - 1
        self.kth[self.row[full]] = self.score[full]


def best_in_span(q_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int,
                 block_rows: int = BLOCK_ROWS) -> _Best:
    """The k best rows of a span for each query, block by block."""
    cuts = range(0, len(ids), block_rows)
    high = np.stack([rows[c : c + block_rows].max(0) for c in cuts])
    low = np.stack([rows[c : c + block_rows].min(0) for c in cuts])
    # Blocks x dimensions: the part of a query above zero meets the maxima, the rest the minima.
    bounds = _scores(np.maximum(queries, 0), high) + _scores(np.minimum(queries, 0), low)
    order = np.argsort(-bounds, axis=1, kind="stable")
    best = _Best(len(q_ids), k)
    if bounds.dtype != object:
        best.kth, best.score = best.kth.astype(np.float64), best.score.astype(np.float64)
    for step in range(len(cuts)):
        block = order[:, step]
        active = bounds[np.arange(len(q_ids)), block] >= best.kth
        if not active.any():
            break
        for b in np.unique(block[active]):
            chosen = np.flatnonzero(active & (block == b))
            at = cuts[b]
            own = ids[at : at + block_rows]
            scores = _scores(queries[chosen], rows[at : at + block_rows])
            good = (scores >= best.kth[chosen][:, None]) & (own[None, :] != q_ids[chosen][:, None])
            r, c = good.nonzero()
            best.add(chosen[r], scores[r, c], own[c])
    return best


def search(vectors: DataFrame, queries: Column, *, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
           block_rows: int = BLOCK_ROWS, span_rows: int = SPAN_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows of every row for which ``queries`` holds."""
    spans = cut(_packed(_usable(vectors, id_col, vec_col), span_rows))
    groups = cut(_packed(_usable(vectors.filter(queries), id_col, vec_col), GROUP_QUERIES))
    n_spans, n_groups = max(1, spans.count()), max(1, groups.count())
    # A stated query set against all rows, in blocks: every bucket of spans meets every group once.
    bucket = F.pmod(F.xxhash64("place"), F.lit(n_spans)).cast("int")
    group = F.pmod(F.xxhash64("place"), F.lit(n_groups)).cast("int")
    left = spans.withColumn("b", bucket).withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))))
    right = groups.withColumn("g", group).withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(n_spans - 1))))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {n: [np.empty(0, np.int64)] for n in ("query_id", "vec_id", "score")}
        for j in range(right.num_rows):
            q_dim, q_ids, q = _unpacked(right, j)
            for i in range(left.num_rows):
                dim, ids, rows = _unpacked(left, i)
                if dim == q_dim:
                    best = best_in_span(q_ids, q, ids, rows, k, block_rows)
                    out["query_id"].append(q_ids[best.row])
                    out["vec_id"].append(best.id)
                    out["score"].append(best.score.astype(np.int64))
        return pa.table({n: np.concatenate(x) for n, x in out.items()})

    found = left.groupBy("b", "g").cogroup(right.groupBy("b", "g"))
    found = found.applyInArrow(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def oracle(k: int = 5) -> str:
    """DuckDB SQL: every query against every row."""
    return f"""
with v as (
  select vec_id, [floor(256 * x::double)::bigint for x in embedding] e, len(embedding) n from embeddings
  where embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0
), scored as (
  select q.vec_id query_id, c.vec_id,
    list_inner_product(q.e::double[], c.e::double[])::bigint score
  from v q join v c on q.n = c.n and q.vec_id <> c.vec_id where q.vec_id % 50 = 0
)
select query_id, rank::int rank, vec_id, score from (
  select *, row_number() over (partition by query_id order by score desc, vec_id) rank from scored
) where rank <= {k}
"""
