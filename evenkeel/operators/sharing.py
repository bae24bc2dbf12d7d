"""Match columns of two tables by the values they share, for those whose names do not tell.

A theta sketch per column, all columns of a table in one scan, estimates how many values two columns share;
only pairs that may reach the cutoff are counted exactly, all of them in one shuffle of their values. No two
columns are joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.normalize import plain
from ..functions.typed import as_numeric, text

CUTOFF = 0.5
#: Binary logarithm of a sketch's entries; its error is about 2 / sqrt(entries).
_LOG_ENTRIES = 12
#: Estimates count as reaching the cutoff from so far below.
_MARGIN = 0.2


def value_text(raw: Column, dtype: T.DataType) -> Column:
    """One text per value whatever type holds it; NULL and blank are NULL."""
    value = F.nullif(text(plain(raw, dtype)), F.lit(""))
    return F.coalesce(as_numeric(value).cast("string"), F.regexp_replace(value, " 00:00:00$", ""))


def _values(df: DataFrame) -> dict[str, Column]:
    return {f.name: value_text(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields}


def value_sketches(df: DataFrame, side: str) -> DataFrame:
    """(<side>_column, <side>_sketch, <side>_estimate) of every column, in one scan."""
    found = df.agg(*[F.theta_sketch_agg(v, _LOG_ENTRIES).alias(f"s{i}") for i, v in enumerate(_values(df).values())])
    rows = [F.struct(F.lit(name).alias(f"{side}_column"), F.col(f"s{i}").alias(f"{side}_sketch")) for i, name in enumerate(df.columns)]
    listed = found.select(F.inline(F.array(*rows)))
    return listed.withColumn(f"{side}_estimate", F.theta_sketch_estimate(f"{side}_sketch"))


def candidates(source: DataFrame, target: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """(source_column, target_column, estimate) of the pairs of columns that may reach the cutoff.

    The pairs are as many as the schemas' columns make, whatever the rows.
    """
    left = value_sketches(source, "source").withColumn("both", F.lit(0))
    right = value_sketches(target, "target").withColumn("both", F.lit(0))
    shared = F.theta_sketch_estimate(F.theta_intersection("source_sketch", "target_sketch")).cast("double")
    larger = F.greatest("source_estimate", "target_estimate")
    pairs = left.join(right, "both").filter(larger > 0).withColumn("estimate", shared / larger)
    return pairs.filter(F.col("estimate") >= cutoff - _MARGIN).select("source_column", "target_column", "estimate")


def shared_values(source: DataFrame, target: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """(source_column, target_column, source_values, target_values, shared_values): exact distinct counts.

    The values of all pairs make one tagged union that is grouped once; copies are dropped before.
    """
    if not pairs:
        empty = "source_column string, target_column string, source_values long, target_values long, shared_values long"
        return source.sparkSession.createDataFrame([], empty)

    def marked(df: DataFrame, names: list[str], side: int) -> DataFrame:
        values = _values(df)
        marks = [F.struct(F.lit(i).alias("pair"), values[n].alias("value"), F.lit(side).alias("side")) for i, n in enumerate(names)]
        return df.select(F.inline(F.array(*marks))).filter("value is not null")

    marks = marked(source, [s for s, _ in pairs], 1).unionAll(marked(target, [t for _, t in pairs], 2))
    held = marks.groupBy("pair", "value").agg(F.bit_or("side").alias("sides"))
    counts = held.groupBy("pair").agg(
        F.count_if(F.col("sides") != 2).alias("source_values"),
        F.count_if(F.col("sides") != 1).alias("target_values"),
        F.count_if(F.col("sides") == 3).alias("shared_values"),
    )
    names = [F.array(*[F.lit(p[k]) for p in pairs])[F.col("pair")] for k in (0, 1)]
    return counts.select(names[0].alias("source_column"), names[1].alias("target_column"), "source_values", "target_values", "shared_values")


def match_by_values(source: DataFrame, target: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """Pairs of columns that are each other's best partner and share the cutoff of the larger one's values.

    ``overlap`` is the shared distinct values over those of the column that has more; on ties the first name
    wins. NULL and blank are no values, so a column without others has no partner.
    """
    if not 0 < cutoff <= 1:
        raise ValueError("cutoff must lie above 0 and not above 1")
    found = candidates(source, target, cutoff).select("source_column", "target_column").collect()  # at most columns x columns
    counted = shared_values(source, target, sorted((r[0], r[1]) for r in found))
    overlap = F.col("shared_values") / F.greatest("source_values", "target_values")
    counted = counted.withColumn("overlap", overlap).filter(F.col("overlap") >= cutoff)

    def place(by: str, other: str) -> Column:
        return F.row_number().over(Window.partitionBy(by).orderBy(F.desc("overlap"), F.desc("shared_values"), other))

    ranked = counted.withColumns({"a": place("source_column", "target_column"), "b": place("target_column", "source_column")})
    return ranked.filter("a = 1 and b = 1").drop("a", "b")
