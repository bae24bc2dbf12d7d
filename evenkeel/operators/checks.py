"""Counting checks. Every check gives rows of (validation_name, counter, value, status)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.typed import cast_fails
from ..mapping import Mapping


def _verdict(failed: Column) -> Column:
    return F.when(failed, F.lit("FAIL")).otherwise(F.lit("PASS"))


def check_rows(totals: DataFrame, name: str, counters: list[str], failed: Column) -> DataFrame:
    """Turn counters of a one-row frame into check rows."""
    return totals.select(F.inline(_check_array(name, counters, failed)))


def _check_array(name: str, counters: list[str], failed: Column) -> Column:
    return F.array(
        *[
            F.struct(
                F.lit(name).alias("validation_name"),
                F.lit(counter).alias("counter"),
                F.col(counter).cast("bigint").alias("value"),
                _verdict(failed).alias("status"),
            )
            for counter in counters
        ]
    )


def row_count_check(source: DataFrame, target: DataFrame) -> DataFrame:
    one = source.agg(F.count(F.lit(1)).alias("n")).select(F.col("n").alias("s"), F.lit(0).alias("t"))
    two = target.agg(F.count(F.lit(1)).alias("n")).select(F.lit(0).alias("s"), F.col("n").alias("t"))
    totals = one.unionAll(two).agg(
        F.sum("s").alias("source_row_count"), F.sum("t").alias("target_row_count")
    )
    counters = ["source_row_count", "target_row_count"]
    failed = F.col(counters[0]) != F.col(counters[1])
    return check_rows(totals, "row_count_validation", counters, failed)


def partition_count_check(
    source: DataFrame, target: DataFrame, source_by: str, target_by: str
) -> DataFrame:
    """Rows of both sides per value of a business partition column."""

    def counts(df: DataFrame, by: str, side: str) -> DataFrame:
        part = F.coalesce(F.trim(F.col(f"`{by}`").cast("string")), F.lit(""))
        return df.groupBy(part.alias("partition")).agg(F.count(F.lit(1)).alias(side))

    both = counts(source, source_by, "s").join(
        counts(target, target_by, "t"), "partition", "full_outer"
    )
    s, t = F.coalesce("s", F.lit(0)), F.coalesce("t", F.lit(0))
    return both.select(
        "partition",
        s.cast("bigint").alias("source_row_count"),
        t.cast("bigint").alias("target_row_count"),
        _verdict(s != t).alias("status"),
    )


def physical_partitions(source: DataFrame, target: DataFrame) -> dict[str, int]:
    """Numbers of partitions of both plans; a property of the layout, not of the data."""
    return {
        "source_partition_count": source.rdd.getNumPartitions(),
        "target_partition_count": target.rdd.getNumPartitions(),
    }


def cast_failures(df: DataFrame, mapping: Mapping, side: str) -> DataFrame:
    """Values per column that do not fit the declared type, all counted in one pass."""
    present = set(df.columns)
    checked = [c for c in mapping.columns if c.on(side) in present and c.kind != "string"]
    totals = df.agg(
        F.lit(0).cast("bigint").alias("_none"),
        *[
            F.count_if(
                cast_fails(
                    F.col(f"`{c.on(side)}`"),
                    c.kind,
                    c.date_format,
                    df.schema[c.on(side)].dataType,
                )
            ).alias(mapping.name(c))
            for c in checked
        ],
    )
    rows = []
    for c in mapping.columns:
        count = F.col(f"`{mapping.name(c)}`") if c in checked else F.col("_none")
        status = _verdict(count > 0) if c.on(side) in present else F.lit("SKIPPED")
        rows.append(
            F.struct(
                F.lit(side).alias("dataset_name"),
                F.lit(mapping.name(c)).alias("column_name"),
                F.lit(c.data_type).alias("declared_data_type"),
                count.alias("cast_failure_count"),
                status.alias("status"),
            )
        )
    return totals.select(F.inline(F.array(*rows)))


def cast_failure_check(failures: DataFrame, side: str) -> DataFrame:
    totals = failures.agg(
        F.count_if(F.col("cast_failure_count") > 0).alias("failed_columns"),
        F.sum("cast_failure_count").alias("total_cast_failures"),
    )
    counters = ["failed_columns", "total_cast_failures"]
    failed = F.col("total_cast_failures") > 0
    return check_rows(totals, f"{side}_cast_failure_validation", counters, failed)


def key_totals(pairs: DataFrame) -> DataFrame:
    """One row with all counters of a paired or classified frame."""
    counters = [
        F.sum("n_src").alias("source_row_count"),
        F.sum("n_tgt").alias("target_row_count"),
        F.count_if(F.col("n_src") > 1).alias("source_duplicates"),
        F.count_if(F.col("n_tgt") > 1).alias("target_duplicates"),
        F.count_if(F.col("n_tgt") == 0).alias("extra_records_in_source_count"),
        F.count_if(F.col("n_src") == 0).alias("extra_records_in_target_count"),
        F.count_if((F.col("n_src") > 0) & (F.col("n_tgt") > 0)).alias("matched_key_count"),
    ]
    if "changed" in pairs.columns:
        counters += [
            F.count_if(F.size("changed") > 0).alias("mismatch_record_count"),
            F.sum(F.size("changed")).alias("mismatch_field_count"),
        ]
    totals = pairs.agg(*counters)
    return totals.select(
        *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in totals.columns]
    )


def duplicate_key_check(totals: DataFrame, side: str) -> DataFrame:
    one = totals.select(F.col(f"{side}_duplicates").alias("duplicate_key_count"))
    name = f"{side}_duplicate_key_validation"
    return check_rows(one, name, ["duplicate_key_count"], F.col("duplicate_key_count") > 0)


def missing_extra_check(totals: DataFrame) -> DataFrame:
    counters = [
        "extra_records_in_source_count",
        "extra_records_in_target_count",
        "matched_key_count",
    ]
    failed = (F.col(counters[0]) > 0) | (F.col(counters[1]) > 0)
    return check_rows(totals, "missing_extra_by_key_validation", counters, failed)


def mismatch_check(totals: DataFrame) -> DataFrame:
    counters = ["mismatch_record_count", "mismatch_field_count"]
    return check_rows(totals, "hash_mismatch_validation", counters, F.col(counters[0]) > 0)


def key_checks(totals: DataFrame) -> DataFrame:
    """All checks that a classified frame answers, from one pass over it."""
    one = totals.select(
        "*",
        F.col("source_duplicates").alias("duplicate_key_count"),
    )
    col = F.col
    parts = [
        _check_array(
            "row_count_validation",
            ["source_row_count", "target_row_count"],
            col("source_row_count") != col("target_row_count"),
        ),
        _check_array(
            "source_duplicate_key_validation",
            ["duplicate_key_count"],
            col("source_duplicates") > 0,
        ),
        F.transform(
            _check_array(
                "target_duplicate_key_validation",
                ["target_duplicates"],
                col("target_duplicates") > 0,
            ),
            lambda r: r.withField("counter", F.lit("duplicate_key_count")),
        ),
        _check_array(
            "missing_extra_by_key_validation",
            [
                "extra_records_in_source_count",
                "extra_records_in_target_count",
                "matched_key_count",
            ],
            (col("extra_records_in_source_count") > 0) | (col("extra_records_in_target_count") > 0),
        ),
        _check_array(
            "hash_mismatch_validation",
            ["mismatch_record_count", "mismatch_field_count"],
            col("mismatch_record_count") > 0,
        ),
    ]
    return one.select(F.inline(F.concat(*parts)))


def mismatch_by_column(classified: DataFrame) -> DataFrame:
    return (
        classified.select(F.explode("changed").alias("column_name"))
        .groupBy("column_name")
        .agg(F.count(F.lit(1)).alias("update_count"))
    )


def null_counts(df: DataFrame) -> DataFrame:
    """NULLs per column, counted in one pass."""
    totals = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("null_count"))
        for c in df.columns
    ]
    return totals.select(F.inline(F.array(*rows)))


def overall_status(checks: DataFrame) -> DataFrame:
    """FAIL if any check failed; warnings and informational rows do not count."""
    failed = F.max(F.when(F.col("status") == "FAIL", F.lit(1)).otherwise(F.lit(0)))
    return checks.agg(_verdict(F.coalesce(failed, F.lit(0)) == 1).alias("overall_status"))
