"""Details read off a classified frame, and the key checks that need only the keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.normalize import norm_value, row_hash
from ..mapping import Mapping
from ..sources.save import settle
from .classify import field_differs, key_columns, keyed, paired, survivors


def raw_keys(mapping: Mapping, side: str) -> list[Column]:
    return [F.col(side).getField(k).alias(k) for k in mapping.key_names]


def key_presence(
    source: DataFrame, target: DataFrame, mapping: Mapping, null_keys: str = "equal"
) -> DataFrame:
    """A paired frame that carries the key columns only."""
    return paired(source, target, mapping, mapping.keys, null_keys)


def extra_in_source(pairs: DataFrame, mapping: Mapping) -> DataFrame:
    return pairs.filter("n_tgt = 0").select(*raw_keys(mapping, "src"))


def extra_in_target(pairs: DataFrame, mapping: Mapping) -> DataFrame:
    return pairs.filter("n_src = 0").select(*raw_keys(mapping, "tgt"))


def matched_keys(pairs: DataFrame, mapping: Mapping) -> DataFrame:
    """Normalized keys found on both sides, under the key names."""
    found = pairs.filter("n_src > 0 and n_tgt > 0")
    return found.select(*[F.col(f"_k{i}").alias(k) for i, k in enumerate(mapping.key_names)])


def distinct_keys(df: DataFrame, mapping: Mapping, side: str) -> DataFrame:
    rows = keyed(df, mapping, side, mapping.keys)
    names = zip(key_columns(mapping), mapping.key_names)
    return rows.select(*[F.col(k).alias(n) for k, n in names]).distinct()


def duplicate_keys(df: DataFrame, mapping: Mapping, side: str) -> DataFrame:
    """Keys with more than one row: least raw key and number of rows."""
    rows = keyed(df, mapping, side, mapping.keys)
    groups = survivors(rows, key_columns(mapping), "count", keys_only=True)
    names = [F.col("row").getField(k).alias(k) for k in mapping.key_names]
    return groups.filter(F.col("count") > 1).select(*names, "count")


def duplicate_rows(df: DataFrame, mapping: Mapping, side: str) -> DataFrame:
    """All rows whose key occurs more than once, with that number as ``duplicate_count``.

    The repeated keys are stored first, so that the join reads plain shuffles, which adaptive execution
    can split where one key holds most rows."""
    keys = key_columns(mapping)
    rows = keyed(df, mapping, side)
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("duplicate_count"))
    found = rows.join(settle(counts.filter("duplicate_count > 1")), keys)
    return found.select("row.*", "duplicate_count")


def dedupe_by_key(df: DataFrame, mapping: Mapping, side: str) -> DataFrame:
    """The least row of every key."""
    return survivors(keyed(df, mapping, side), key_columns(mapping)).select("row.*")


def mismatch_long(pairs: DataFrame, mapping: Mapping) -> DataFrame:
    """One row per differing value: raw keys, column_name, source_value, target_value."""
    src, tgt = F.col("src"), F.col("tgt")
    values = [
        F.struct(
            F.lit(mapping.name(c)).alias("column_name"),
            src.getField(mapping.name(c)).cast("string").alias("source_value"),
            tgt.getField(mapping.name(c)).cast("string").alias("target_value"),
            field_differs(pairs, mapping, c).alias("differs"),
        )
        for c in mapping.compare
    ]
    both = pairs.filter("n_src > 0 and n_tgt > 0")
    wanted = F.filter(F.array(*values), lambda v: v["differs"])
    found = both.select(*raw_keys(mapping, "src"), F.inline(wanted))
    return found.drop("differs")


def mismatch_wide(pairs: DataFrame, mapping: Mapping) -> DataFrame:
    """One row per differing row: raw keys, source_c and target_c per column, mismatched_columns."""
    src, tgt = F.col("src"), F.col("tgt")
    both = pairs.filter("n_src > 0 and n_tgt > 0")
    flags = [
        F.when(field_differs(pairs, mapping, c), F.lit(mapping.name(c))) for c in mapping.compare
    ]
    values = []
    for name in mapping.compare_names:
        values.append(src.getField(name).alias(f"source_{name}"))
        values.append(tgt.getField(name).alias(f"target_{name}"))
    wide = both.select(
        *raw_keys(mapping, "src"),
        *values,
        F.concat_ws(",", F.array(*flags)).alias("mismatched_columns"),
    )
    return wide.filter("mismatched_columns <> ''")


def hash_mismatch_rows(pairs: DataFrame, mapping: Mapping) -> DataFrame:
    """Raw keys and both row hashes of the matched rows whose hashes differ."""

    def hashed(side: str) -> Column:
        fields = pairs.schema[side].dataType
        return row_hash(
            *[
                norm_value(
                    F.col(side).getField(mapping.name(c)),
                    c.kind,
                    c.date_format,
                    fields[mapping.name(c)].dataType,
                    mapping.unfit,
                )
                for c in mapping.compare
            ]
        )

    both = pairs.filter("n_src > 0 and n_tgt > 0").select(
        *raw_keys(mapping, "src"),
        hashed("src").alias("source_row_hash"),
        hashed("tgt").alias("target_row_hash"),
    )
    return both.filter(F.col("source_row_hash") != F.col("target_row_hash"))


def detail_head(df: DataFrame, order: list[str], limit: int) -> DataFrame:
    """The first rows in key order, as the reports show them."""
    return df.orderBy(*order).limit(limit)
