"""Infer declared types of columns from all of their values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.typed import text
from .small import small_frame

# What a text can look like, in order of precedence: data type, date_format, pattern.
SHAPES = [
    ("integer", None, r"^-?\d+$"),
    ("double", None, r"^-?\d+\.\d+$"),
    ("boolean", None, r"^(?i:true|false)$"),
    ("timestamp", "yyyy-MM-dd H:mm[:ss]", r"^\d{4}-\d{2}-\d{2}\s+\d{2}:\d{2}(:\d{2})?$"),
    ("timestamp", "M/d/yyyy H:mm[:ss]", r"^\d{1,2}/\d{1,2}/\d{4}\s+\d{1,2}:\d{2}(:\d{2})?$"),
    ("date", "yyyy-MM-dd", r"^\d{4}-\d{2}-\d{2}$"),
    ("date", "M/d/yyyy", r"^\d{1,2}/\d{1,2}/\d{4}$"),
    ("date", "dd-MM-yyyy", r"^\d{2}-\d{2}-\d{4}$"),
]
_OTHER = 1 << len(SHAPES)


def _shape_bit(value: Column, blanks: str) -> Column:
    """One bit per shape, so that a bitwise OR over a column shows every shape it holds."""
    x = text(value)
    bit = F.when(value.isNull(), F.lit(None).cast("int"))
    if blanks == "ignore":
        bit = bit.when(x == "", F.lit(None).cast("int"))
    plain, other = F.when(F.lit(False), F.lit(0)), F.lit(_OTHER)
    for i, (kind, pattern, regex) in enumerate(SHAPES):
        fits = x.rlike(regex)
        if kind == "boolean":  # the only shape that does not begin like a number
            bit = bit.when(~x.rlike(r"^-?\d"), F.when(fits, F.lit(1 << i)).otherwise(other))
            continue
        if kind == "date":
            day = x.try_cast("date") if pattern == "yyyy-MM-dd" else F.try_to_date(x, pattern)
            fits = fits & day.isNotNull()
        plain = plain.when(fits, F.lit(1 << i))
    return bit.otherwise(plain.otherwise(other))


def _native(dtype: T.DataType) -> tuple[str, str | None] | None:
    """Type of a column that is not text; None where the values must be looked at."""
    if isinstance(dtype, T.BooleanType):
        return "boolean", None
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "integer", None
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return "double", None
    if isinstance(dtype, T.DateType):
        return "date", "yyyy-MM-dd"
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return "timestamp", "yyyy-MM-dd HH:mm:ss"
    if isinstance(dtype, (T.StringType, T.DecimalType)):
        return None
    return "string", None


def infer_types(df: DataFrame, blanks: str = "ignore") -> DataFrame:
    """column_name, ordinal, data_type, date_format of every column, from one pass over the rows.

    A column has a type when all its values look like it. ``blanks="string"`` makes a blank value
    turn its column into text.
    """
    if blanks not in ("ignore", "string"):
        raise ValueError(f"blanks must be 'ignore' or 'string', not {blanks!r}")
    values, known = [], []
    for i, f in enumerate(df.schema.fields):
        native = _native(f.dataType)
        known.append((f.name, i, *(native or (None, None))))
        if native is None:
            value = F.col(f"`{f.name}`")
            if isinstance(f.dataType, T.DecimalType):
                value = F.when(value == F.floor(value), "0").otherwise(value.cast("string"))
            values.append(F.struct(F.lit(i).alias("ordinal"), value.alias("v")))
    columns = small_frame(
        df.sparkSession,
        known,
        "column_name string, ordinal int, data_type string, date_format string",
    )
    if not values:
        return columns
    # One shape expression over (column, value) rows; they are reduced to one mask per column
    # before the shuffle, and the masks are as many as there are columns.
    shapes = df.select(F.inline(F.array(*values))).groupBy("ordinal")
    masks = shapes.agg(F.bit_or(_shape_bit(F.col("v"), blanks)).alias("mask"))
    mask = F.col("mask")
    kind = F.when(mask == 1, "integer").when((mask == 2) | (mask == 3), "double")
    pattern = F.when(F.lit(False), F.lit(""))
    for bit, (name, shape, _) in list(enumerate(SHAPES))[2:]:
        kind = kind.when(mask == (1 << bit), name)
        pattern = pattern.when(mask == (1 << bit), shape)
    found = columns.join(F.broadcast(masks), "ordinal", "left")
    return found.select(
        "column_name",
        "ordinal",
        F.coalesce("data_type", kind.otherwise("string")).alias("data_type"),
        F.coalesce("date_format", pattern).alias("date_format"),
    )
