"""Schema drift over a column catalog that may describe many table pairs at once.

A catalog has one row per column: pair, side ('source' or 'target'), column_name, ordinal, data_type.
The declarations have one row per mapped column: pair, column_name, declared_data_type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..mapping import KINDS, SPARK_TYPES, Mapping
from .small import small_frame

CATALOG = "pair string, side string, column_name string, ordinal int, data_type string"
DECLARED = "pair string, column_name string, declared_data_type string"

# Type families by Spark type name.
FAMILIES = {
    "integer": ["byte", "tinyint", "short", "smallint", "int", "integer", "bigint", "long"],
    "floating": ["float", "double"],
    "string": ["string"],
    "boolean": ["boolean"],
    "date": ["date"],
    "timestamp": ["timestamp", "timestamp_ntz"],
}

# Families each declared type may be stored as; other declared types fit any.
COMPATIBLE = {
    "numeric": ["integer", "floating", "decimal"],
    "string": ["string"],
    "boolean": ["boolean"],
    "date": ["date", "timestamp", "string"],
    "timestamp": ["timestamp", "string"],
}


def column_catalog(
    spark: SparkSession, df: DataFrame, pair: str, side: str, mapping: Mapping | None = None
) -> DataFrame:
    """Catalog rows of one table; with a mapping, columns carry its common names."""
    common = {c.on(side): mapping.name(c) for c in mapping.columns} if mapping else {}
    rows = [
        (pair, side, common.get(f.name, f.name), i, f.dataType.simpleString())
        for i, f in enumerate(df.schema.fields)
    ]
    return small_frame(spark, rows, CATALOG)


def declared_columns(spark: SparkSession, pair: str, mapping: Mapping) -> DataFrame:
    rows = [(pair, mapping.name(c), c.data_type) for c in mapping.columns]
    return small_frame(spark, rows, DECLARED)


def column_types(declared: DataFrame, catalog: DataFrame) -> DataFrame:
    """Declared column with its type on both sides, NULL where a side lacks it; one shuffle."""
    none = F.lit(None).cast("string")
    side_type = lambda side: F.when(F.col("side") == side, F.col("data_type"))
    wanted = declared.select(
        "pair", "column_name", "declared_data_type", none.alias("s"), none.alias("t")
    )
    found = catalog.select(
        "pair",
        "column_name",
        none.alias("declared_data_type"),
        side_type("source").alias("s"),
        side_type("target").alias("t"),
    )
    return (
        wanted.unionByName(found)
        .groupBy("pair", "column_name")
        .agg(
            F.min("declared_data_type").alias("declared_data_type"),
            F.min("s").alias("source_data_type"),
            F.min("t").alias("target_data_type"),
        )
        .filter(F.col("declared_data_type").isNotNull())
    )


def _verdicts(types: DataFrame, drift: Column, warn: tuple[str, ...] = ()) -> DataFrame:
    rows = types.select(
        "pair",
        "column_name",
        "declared_data_type",
        F.col("source_data_type").isNotNull().alias("source_exists"),
        F.col("target_data_type").isNotNull().alias("target_exists"),
        "source_data_type",
        "target_data_type",
        drift.alias("drift_type"),
    )
    status = F.when(F.col("drift_type") == "NO_DRIFT", "PASS")
    if warn:
        status = status.when(F.col("drift_type").isin(*warn), "WARN")
    return rows.withColumn("status", status.otherwise("FAIL"))


def _sides() -> tuple[Column, Column]:
    return F.col("source_data_type"), F.col("target_data_type")


def drift_exact(types: DataFrame) -> DataFrame:
    """Types must be equal."""
    s, t = _sides()
    drift = (
        F.when(s.isNull(), "MISSING_IN_SOURCE")
        .when(t.isNull(), "MISSING_IN_TARGET")
        .when(s != t, "DATA_TYPE_MISMATCH")
        .otherwise("NO_DRIFT")
    )
    return _verdicts(types, drift)


def type_family(data_type: Column) -> Column:
    """Family of a Spark type name, 'unknown' for NULL."""
    t = F.lower(data_type)
    family = F.when(t.isNull(), "unknown").when(t.startswith("decimal"), "decimal")
    family = family.when(t.startswith("varchar") | t.startswith("char"), "string")
    for name, types in FAMILIES.items():
        family = family.when(t.isin(*types), name)
    return family.otherwise("other")


def _fits(data_type: Column, declared: Column) -> Column:
    family = type_family(data_type)
    fits = F.when(F.lit(False), F.lit(True))
    for kind, families in COMPATIBLE.items():
        fits = fits.when(F.lower(declared) == kind, family.isin(*families))
    return fits.otherwise(F.lit(True))


def drift_family(types: DataFrame) -> DataFrame:
    """Types must suit the declaration; different types that both do are a warning."""
    declared, (s, t) = F.col("declared_data_type"), _sides()
    drift = (
        F.when(s.isNull(), "MISSING_IN_SOURCE")
        .when(t.isNull(), "MISSING_IN_TARGET")
        .when(~_fits(s, declared) | ~_fits(t, declared), "DECLARED_TYPE_INCOMPATIBLE")
        .when(s == t, "NO_DRIFT")
        .otherwise("COMPATIBLE_TYPE_VARIATION")
    )
    return _verdicts(types, drift, warn=("COMPATIBLE_TYPE_VARIATION",))


def expected_type(declared: Column) -> Column:
    """Spark type a declared type is compared as."""
    kind = F.lower(F.trim(declared))
    expected = F.when(F.lit(False), F.lit(""))
    for name, known in KINDS.items():
        expected = expected.when(kind == name, SPARK_TYPES[known])
    return expected.otherwise("string")


def drift_typed(types: DataFrame) -> DataFrame:
    """Types of the typed columns must be the ones the declarations ask for."""
    expected, (s, t) = expected_type(F.col("declared_data_type")), _sides()
    drift = (
        F.when(s.isNull(), "MISSING_TYPED_COLUMN_IN_SOURCE")
        .when(t.isNull(), "MISSING_TYPED_COLUMN_IN_TARGET")
        .when((s != expected) | (t != expected), "DECLARED_TYPE_CAST_MISMATCH")
        .when(s != t, "TYPE_MISMATCH_AFTER_CAST")
        .otherwise("NO_DRIFT")
    )
    return _verdicts(types, drift)


def drift_check(drift: DataFrame) -> DataFrame:
    """Drift counters of every pair."""
    counts = drift.groupBy("pair").agg(
        F.count(F.lit(1)).alias("total_columns_checked"),
        F.count_if(F.col("status") == "FAIL").alias("total_drift_columns"),
        F.count_if(F.col("status") == "WARN").alias("total_warn_columns"),
        F.count_if(
            F.col("drift_type").isin("DATA_TYPE_MISMATCH", "TYPE_MISMATCH_AFTER_CAST")
        ).alias("datatype_mismatch_count"),
        F.count_if(F.col("drift_type") == "COMPATIBLE_TYPE_VARIATION").alias(
            "compatible_type_variation_count"
        ),
        F.count_if(F.col("drift_type") == "DECLARED_TYPE_INCOMPATIBLE").alias(
            "declared_type_incompatible_count"
        ),
        F.count_if(F.col("drift_type") == "DECLARED_TYPE_CAST_MISMATCH").alias(
            "failed_declared_type_cast_columns"
        ),
        F.count_if(~F.col("source_exists")).alias("missing_columns_in_source"),
        F.count_if(F.col("source_exists") & ~F.col("target_exists")).alias(
            "missing_columns_in_target"
        ),
    )
    status = F.when(F.col("total_drift_columns") > 0, "FAIL").otherwise("PASS")
    return counts.withColumn("status", status)
