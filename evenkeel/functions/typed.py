"""Cast raw values to their declared type; what cannot be cast becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What Spark reads as a number or a truth value.
_DIGITS = r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?"
NUMBER = rf"^\s*{_DIGITS}\s*$"
FLOATING = rf"^\s*({_DIGITS}[dDfF]?|[+-]?(?i:inf|infinity|nan))\s*$"
WHOLE = r"^\s*[+-]?\d+(\.\d*)?\s*$"
TRUE = ("t", "true", "y", "yes", "1")
FALSE = ("f", "false", "n", "no", "0")

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NUMBER = (*_WHOLE, T.FloatType, T.DoubleType, T.DecimalType)


def text(raw: Column) -> Column:
    return F.trim(raw.cast("string"))


def is_blank(raw: Column) -> Column:
    return raw.isNull() | (text(raw) == "")


def _guarded(raw: Column, shape: str, data_type: str) -> Column:
    """Cast only texts of the right shape: a failing cast costs far more than a pattern test."""
    x = text(raw)
    return F.when(x.rlike(shape), x).try_cast(data_type)


def as_numeric(raw: Column) -> Column:
    return _guarded(raw, NUMBER, "decimal(38,10)")


def as_integer(raw: Column) -> Column:
    """Whole part of a decimal number: ``1.9`` is 1, overflow is NULL."""
    x = text(raw)
    return F.when(x.rlike(WHOLE), F.substring_index(x, ".", 1)).try_cast("bigint")


def as_double(raw: Column) -> Column:
    return _guarded(raw, FLOATING, "double")


def as_boolean(raw: Column) -> Column:
    x = F.lower(F.trim(raw.cast("string"), F.lit(" \t\r\n")))
    return F.when(x.isin(*TRUE), F.lit(True)).when(x.isin(*FALSE), F.lit(False))


def as_date(raw: Column, pattern: str | None = None) -> Column:
    return F.try_to_date(text(raw), pattern) if pattern else text(raw).try_cast("date")


def as_timestamp(raw: Column, pattern: str | None = None) -> Column:
    if pattern:
        return F.try_to_timestamp(text(raw), F.lit(pattern))
    return text(raw).try_cast("timestamp")


def typed(
    raw: Column, kind: str, pattern: str | None = None, dtype: T.DataType | None = None
) -> Column:
    """``raw`` as its declared kind. A known physical type saves the detour over text."""
    if kind == "numeric":
        return raw.try_cast("decimal(38,10)") if isinstance(dtype, _NUMBER) else as_numeric(raw)
    if kind == "integer":
        return raw.try_cast("bigint") if isinstance(dtype, _NUMBER) else as_integer(raw)
    if kind == "double":
        return raw.cast("double") if isinstance(dtype, _NUMBER) else as_double(raw)
    if kind == "boolean":
        return raw if isinstance(dtype, T.BooleanType) else as_boolean(raw)
    if kind == "date":
        if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return raw.cast("date")
        return as_date(raw, pattern)
    if kind == "timestamp":
        if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return raw.cast("timestamp")
        return as_timestamp(raw, pattern)
    return text(raw)


def cast_fails(
    raw: Column, kind: str, pattern: str | None = None, dtype: T.DataType | None = None
) -> Column:
    """True where a value is present but does not fit its declared kind."""
    return ~is_blank(raw) & typed(raw, kind, pattern, dtype).isNull()
