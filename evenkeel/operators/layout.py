"""Names, order, types and nesting of columns."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.normalize import norm
from ..functions.typed import typed
from ..mapping import Mapping


class MissingColumns(ValueError):
    """A table lacks columns its mapping names."""


def rename_to_common(df: DataFrame, mapping: Mapping, side: str) -> DataFrame:
    """Give mapped columns their common names; other columns stay."""
    names = {c.on(side): mapping.name(c) for c in mapping.columns}
    return df.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in df.columns])


def require_columns(df: DataFrame, mapping: Mapping, side: str, strict: bool = True) -> list[str]:
    """Mapped columns the table does not have; raises unless ``strict`` is off."""
    present = set(df.columns)
    missing = [c.on(side) for c in mapping.columns if c.on(side) not in present]
    if missing and strict:
        raise MissingColumns(f"{side} lacks columns {missing}")
    return missing


def missing_columns(required: DataFrame, catalog: DataFrame) -> DataFrame:
    """Required (pair, side, column_name) rows that the column catalog does not have."""
    return required.join(catalog, ["pair", "side", "column_name"], "left_anti")


def with_typed(df: DataFrame, mapping: Mapping, side: str, prefix: str = "typed_") -> DataFrame:
    """Add the typed value of every mapped column next to the raw one."""
    fields = df.schema
    extra = [
        typed(F.col(f"`{c.on(side)}`"), c.kind, c.date_format, fields[c.on(side)].dataType)
        .alias(prefix + mapping.name(c))
        for c in mapping.columns
    ]
    return df.select("*", *extra)


def with_norm(df: DataFrame, mapping: Mapping, side: str, prefix: str = "norm_") -> DataFrame:
    """Add the canonical text of every mapped column next to the raw one."""
    fields = df.schema
    extra = [
        norm(F.col(f"`{c.on(side)}`"), c.kind, c.date_format, fields[c.on(side)].dataType)
        .alias(prefix + mapping.name(c))
        for c in mapping.columns
    ]
    return df.select("*", *extra)


def align_target_layout(target: DataFrame, source: DataFrame) -> DataFrame:
    """Source columns first and in source order, absent ones as NULL, other target columns last."""
    have = set(target.columns)
    wanted = [
        F.col(f"`{f.name}`") if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
        for f in source.schema.fields
    ]
    extras = [F.col(f"`{c}`") for c in target.columns if c not in set(source.columns)]
    return target.select(*wanted, *extras)


def cast_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast the columns the schema names; values that do not fit become NULL."""
    wanted = {f.name: f.dataType for f in schema.fields}
    return df.select(
        *[
            F.col(f"`{c}`").try_cast(wanted[c]).alias(c) if c in wanted else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def project_to_schema(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, list[str]]:
    """The schema's columns in its order and types, and the names the table does not have."""
    have = set(df.columns)
    kept = [f for f in schema.fields if f.name in have]
    columns = [F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in kept]
    return df.select(*columns), [f.name for f in schema.fields if f.name not in have]


def dates_as_text(df: DataFrame) -> DataFrame:
    """Dates and timestamps as ISO text, for sides stored in different formats."""

    def shown(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            return F.date_format(value, "yyyy-MM-dd").alias(field.name)
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(value, "yyyy-MM-dd HH:mm:ss").alias(field.name)
        return value

    return df.select(*[shown(f) for f in df.schema.fields])


def flatten_nested(df: DataFrame, delimiter: str = "_", max_depth: int | None = None) -> DataFrame:
    """Struct fields as columns, arrays and maps as JSON text, in one projection.

    What lies deeper than ``max_depth`` levels, where that is given, stays nested.
    """

    def opens(depth: int) -> bool:
        return max_depth is None or depth < max_depth

    def leaves(value: Column, dtype: T.DataType, name: str, depth: int) -> list[Column]:
        if opens(depth) and isinstance(dtype, T.StructType):
            return [
                leaf
                for f in dtype.fields
                for leaf in leaves(
                    value.getField(f.name), f.dataType, f"{name}{delimiter}{f.name}", depth + 1
                )
            ]
        if opens(depth) and isinstance(dtype, (T.ArrayType, T.MapType)):
            value = F.to_json(value)
        names.append(name)
        return [value.alias(name)]

    names: list[str] = []
    columns = [
        leaf
        for f in df.schema.fields
        for leaf in leaves(F.col(f"`{f.name}`"), f.dataType, f.name, 0)
    ]
    clashes = [n for n, times in Counter(names).items() if times > 1]
    if clashes:
        raise ValueError(f"flattened names are not unique: {clashes}")
    return df.select(*columns)
