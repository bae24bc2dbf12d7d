"""Make a mapping from two tables: match their columns by name and infer the source's types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..mapping import ColumnMap, Mapping
from ..operators.drift import column_catalog
from ..operators.matching import CUTOFF, match_columns
from ..operators.profile import infer_types
from ..operators.sharing import match_by_values
from ..operators.small import small_frame
from ..sources.save import settle

OVERRIDES = "pair string, source_column string, target_column string"


def generate_mapping(
    source: DataFrame,
    target: DataFrame,
    overrides: dict[str, str] | None = None,
    *,
    cutoff: float = CUTOFF,
    values_cutoff: float | None = None,
) -> DataFrame:
    """source_column, target_column, match_type, data_type, date_format of all columns of both tables.

    ``overrides`` suggests targets for source columns whose names do not settle it. With ``values_cutoff``
    columns that are still left over are matched by the values they share (match_type shared-values).
    """
    spark = source.sparkSession
    catalog = column_catalog(spark, source, "", "source").unionByName(
        column_catalog(spark, target, "", "target")
    )
    wishes = None
    if overrides:
        rows = [("", s, t) for s, t in overrides.items()]
        wishes = small_frame(spark, rows, OVERRIDES)
    matches = match_columns(catalog, wishes, cutoff=cutoff).drop("pair")
    if values_cutoff is not None:
        matches = _by_values(settle(matches), source, target, values_cutoff)
    types = infer_types(source).select(
        F.col("column_name").alias("source_column"), "data_type", "date_format"
    )
    return matches.join(types, "source_column", "left").select(
        "source_column", "target_column", "match_type", "data_type", "date_format"
    )


def _by_values(matches: DataFrame, source: DataFrame, target: DataFrame, cutoff: float) -> DataFrame:
    """Give left-over columns the partner whose values they share; a row per column of both tables at most."""
    left = [r[0] for r in matches.filter("match_type = 'unmapped_source'").select("source_column").collect()]
    right = [r[0] for r in matches.filter("match_type = 'unmapped_target'").select("target_column").collect()]
    if not left or not right:
        return matches
    few = match_by_values(source.select(*[f"`{c}`" for c in left]), target.select(*[f"`{c}`" for c in right]), cutoff)
    found = settle(few.select("source_column", "target_column", F.lit("shared-values").alias("match_type")))
    rest = matches.join(found.select("source_column"), "source_column", "left_anti")
    free = F.col("match_type") == "unmapped_target"
    taken = rest.filter(free).join(found.select("target_column"), "target_column", "left_anti")
    names = ["source_column", "target_column", "match_type"]
    return rest.filter(~free).select(names).unionByName(taken.select(names)).unionByName(found)


def to_mapping(rows: DataFrame, keys: list[str], **options) -> Mapping:
    """The generated rows, one per column of the tables, as a mapping."""
    columns = [
        ColumnMap(r.source_column, r.target_column, r.data_type or "string", r.date_format)
        for r in rows.orderBy("source_column", "target_column").collect()
    ]
    return Mapping.of(keys, columns, **options)
