"""Put both tables on common keys, one row per key and side, and classify every key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.normalize import differs, norm_key, plain
from ..mapping import ColumnMap, Mapping


def key_columns(mapping: Mapping, null_keys: str = "equal") -> list[str]:
    keys = [f"_k{i}" for i in range(len(mapping.keys))]
    return [*keys, "_side"] if null_keys == "distinct" else keys


def key_exprs(
    df: DataFrame, mapping: Mapping, side: str, null_keys: str = "equal"
) -> list[Column]:
    """Normalized key texts. With ``null_keys="distinct"`` a key with a NULL meets no other side."""
    exprs = [
        norm_key(F.col(f"`{c.on(side)}`"), c.kind, c.date_format, df.schema[c.on(side)].dataType)
        .alias(f"_k{i}")
        for i, c in enumerate(mapping.keys)
    ]
    if null_keys == "distinct":
        missing = F.lit(False)
        for c in mapping.keys:
            missing = missing | F.col(f"`{c.on(side)}`").isNull()
        exprs.append(F.when(missing, F.lit(side)).otherwise(F.lit("")).alias("_side"))
    elif null_keys != "equal":
        raise ValueError(f"null_keys must be 'equal' or 'distinct', not {null_keys!r}")
    return exprs


def keyed(
    df: DataFrame,
    mapping: Mapping,
    side: str,
    columns: tuple[ColumnMap, ...] | None = None,
    null_keys: str = "equal",
) -> DataFrame:
    """Normalized keys plus one struct ``row`` of raw values under the mapping's common names."""
    columns = mapping.columns if columns is None else columns
    row = F.struct(
        *[
            plain(F.col(f"`{c.on(side)}`"), df.schema[c.on(side)].dataType).alias(mapping.name(c))
            for c in columns
        ]
    )
    return df.select(*key_exprs(df, mapping, side, null_keys), row.alias("row"))


_FIXED_WIDTH = (T.BooleanType, T.IntegralType, T.DateType)


def survivors(
    rows: DataFrame, keys: list[str], count: str = "n", row: str = "row", keys_only: bool = False
) -> DataFrame:
    """One row per key: the least one, with the number of rows it stands for.

    ``keys_only`` says that the rows hold nothing but the raw values of the keys.

    Rows are reduced before the shuffle, so a key with very many rows costs no more than others.
    """
    fields = rows.schema["row"].dataType.fields
    number = F.count(F.lit(1)).alias(count)
    if keys_only and all(isinstance(f.dataType, _FIXED_WIDTH) for f in fields):
        # Hash aggregation can reduce these types, each column on its own.
        least = [F.min(F.col("row").getField(f.name)).alias(f"_v{i}") for i, f in enumerate(fields)]
        whole = F.struct(*[F.col(f"_v{i}").alias(f.name) for i, f in enumerate(fields)])
        return rows.groupBy(*keys).agg(number, *least).select(*keys, count, whole.alias(row))
    return rows.groupBy(*keys).agg(number, F.min("row").alias(row))


def paired(
    source: DataFrame,
    target: DataFrame,
    mapping: Mapping,
    columns: tuple[ColumnMap, ...] | None = None,
    null_keys: str = "equal",
) -> DataFrame:
    """Full outer join of the survivors of both sides: ``n_src, n_tgt, src, tgt`` per key.

    Each side is shuffled once; the join runs on the partitioning and order of the aggregation.
    """
    keys = key_columns(mapping, null_keys)
    bare = columns == mapping.keys
    left = keyed(source, mapping, "source", columns, null_keys)
    right = keyed(target, mapping, "target", columns, null_keys)
    src = survivors(left, keys, "n_src", "src", bare)
    tgt = survivors(right, keys, "n_tgt", "tgt", bare)
    joined = src.join(tgt, keys, "full_outer")
    none = F.lit(0).cast("bigint")
    return joined.select(
        *keys,
        F.coalesce("n_src", none).alias("n_src"),
        F.coalesce("n_tgt", none).alias("n_tgt"),
        "src",
        "tgt",
    )


def field_differs(frame: DataFrame, mapping: Mapping, column: ColumnMap) -> Column:
    """Whether ``src`` and ``tgt`` of a paired frame differ in one column."""
    name = mapping.name(column)
    return differs(
        F.col("src").getField(name),
        F.col("tgt").getField(name),
        column.kind,
        column.date_format,
        frame.schema["src"].dataType[name].dataType,
        frame.schema["tgt"].dataType[name].dataType,
        mapping.unfit,
    )


def changed_columns(frame: DataFrame, mapping: Mapping) -> Column:
    """Names of the compare columns in which the two rows differ."""
    if not mapping.compare:
        return F.array().cast("array<string>")
    flags = [
        F.when(field_differs(frame, mapping, c), F.lit(mapping.name(c))) for c in mapping.compare
    ]
    return F.array_compact(F.array(*flags))


def classify(
    source: DataFrame, target: DataFrame, mapping: Mapping, null_keys: str = "equal"
) -> DataFrame:
    """``paired`` plus ``changed`` and ``state``: source_only, target_only, equal or mismatch."""
    pairs = paired(source, target, mapping, null_keys=null_keys)
    both = (F.col("n_src") > 0) & (F.col("n_tgt") > 0)
    nothing = F.array().cast("array<string>")
    pairs = pairs.withColumn(
        "changed", F.when(both, changed_columns(pairs, mapping)).otherwise(nothing)
    )
    state = (
        F.when(F.col("n_tgt") == 0, "source_only")
        .when(F.col("n_src") == 0, "target_only")
        .when(F.size("changed") > 0, "mismatch")
        .otherwise("equal")
    )
    return pairs.withColumn("state", state)


def slim(classified: DataFrame) -> DataFrame:
    """The same frame without the rows' values where no check or detail reads them.

    Rows that agree and are unique keep only their key and counters, so that what is stored of a
    comparison grows with the findings rather than with the tables.
    """
    found = (F.col("state") != "equal") | (F.col("n_src") > 1) | (F.col("n_tgt") > 1)
    return classified.withColumns(
        {"src": F.when(found, F.col("src")), "tgt": F.when(found, F.col("tgt"))}
    )
