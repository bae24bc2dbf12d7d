"""Readers for report fields that may be missing or of any type."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .typed import text


def lenient_int(value: Column, default: int = 0) -> Column:
    """Whole part of whatever number the field holds, else the default."""
    return F.coalesce(text(value).try_cast("double").try_cast("bigint"), F.lit(default).cast("bigint"))


def split_list(value: Column) -> Column:
    """Trimmed non-empty parts of a comma list; NULL gives an empty list."""
    parts = F.transform(F.split(F.coalesce(value, F.lit("")), ","), lambda p: F.trim(p))
    return F.filter(parts, lambda p: p != "")
