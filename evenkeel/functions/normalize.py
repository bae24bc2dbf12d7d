"""Canonical text of values, so that two tables can be compared whatever types they store."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .typed import as_numeric, cast_fails, text, typed

COMPLEX = (T.StructType, T.ArrayType, T.MapType)
SEPARATOR = "||"
#: Stands before the text of a key that does not fit its declared kind.
UNFIT = "unfit:"


def plain(raw: Column, dtype: T.DataType) -> Column:
    """Nested values as JSON text, others unchanged; the result can always be ordered."""
    return F.to_json(raw) if isinstance(dtype, COMPLEX) else raw


def norm_text(raw: Column, dtype: T.DataType | None = None) -> Column:
    if isinstance(dtype, COMPLEX):
        return F.coalesce(F.to_json(raw), F.lit(""))
    return F.coalesce(text(raw), F.lit(""))


def norm_numeric(raw: Column) -> Column:
    return F.coalesce(as_numeric(raw).cast("string"), F.lit(""))


def norm(
    raw: Column, kind: str, pattern: str | None = None, dtype: T.DataType | None = None
) -> Column:
    """Text of the typed value; NULL, blank and uncastable values are all the empty string."""
    if isinstance(dtype, COMPLEX):
        return norm_text(raw, dtype)
    value = typed(raw, kind, pattern, dtype)
    if kind == "timestamp":
        value = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
    return F.coalesce(value.cast("string"), F.lit(""))


def norm_key(
    raw: Column, kind: str, pattern: str | None = None, dtype: T.DataType | None = None
) -> Column:
    """Canonical text of a key. A value that does not fit its kind keeps its own text behind a tag,
    so that different keys stay different; only NULL and blank are the empty string."""
    if isinstance(dtype, COMPLEX):
        return norm_text(raw, dtype)
    return F.when(cast_fails(raw, kind, pattern, dtype), F.concat(F.lit(UNFIT), text(raw))).otherwise(
        norm(raw, kind, pattern, dtype)
    )


def norm_value(
    raw: Column, kind: str, pattern: str | None, dtype: T.DataType | None, unfit: str = "equal"
) -> Column:
    """Canonical text of a compared value; with ``unfit="distinct"`` as that of a key."""
    return (norm_key if unfit == "distinct" else norm)(raw, kind, pattern, dtype)


def row_hash(*values: Column) -> Column:
    """SHA-256 of the joined values, NULL when there is none to join."""
    if not values:
        return F.lit(None).cast("string")
    return F.sha2(F.concat_ws(SEPARATOR, *[F.coalesce(v, F.lit("")) for v in values]), 256)


def differs(
    left: Column,
    right: Column,
    kind: str,
    pattern: str | None,
    left_type: T.DataType,
    right_type: T.DataType,
    unfit: str = "equal",
) -> Column:
    """True where the canonical texts differ. Equal raw values skip the parsing."""
    one, other = norm_value(left, kind, pattern, left_type, unfit), norm_value(right, kind, pattern, right_type, unfit)
    unequal = one != other
    if left_type == right_type:
        return ~left.eqNullSafe(right) & unequal
    return unequal
