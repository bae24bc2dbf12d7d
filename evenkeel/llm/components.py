"""Connected components of a graph whose edges are a table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, stored


def components(edges: DataFrame) -> DataFrame:
    """``labels`` with tables of its own."""
    with stored(edges.sparkSession) as keep:
        return cut(labels(edges, keep))


def labels(edges: DataFrame, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(id, label): the least id that each end of the edges (a, b) is connected with.

    Every round a node takes the least label of its neighbours and then the label of its label, so the
    rounds grow with the logarithm of the longest path rather than with its length. A node with very many
    edges is a key of plain joins that adaptive execution can split, and sums up before the shuffle."""
    both = keep(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    found = keep(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("id")).alias("label")))
    before = None
    while True:
        total = found.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]
        if total is None or total == before:
            return found
        before = total
        near = both.join(found, F.col("b") == F.col("id")).select(F.col("a").alias("id"), "label")
        near = keep(near.unionByName(found).groupBy("id").agg(F.min("label").alias("label")))
        of = near.select(F.col("id").alias("of_id"), F.col("label").alias("of_label"))
        found = keep(near.join(of, F.col("label") == F.col("of_id")).select("id", F.col("of_label").alias("label")))
