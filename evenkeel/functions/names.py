"""Column-name keys and similarity."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType


def name_key(name: Column) -> Column:
    return F.regexp_replace(F.lower(name), "[^a-z0-9]+", "")


def levenshtein_ratio(a: Column, b: Column) -> Column:
    """1 - distance / longer length; two empty keys are equal."""
    longer = F.greatest(F.length(a), F.length(b))
    return F.when(longer == 0, F.lit(1.0)).otherwise(
        F.lit(1.0) - F.levenshtein(a, b).cast("double") / longer.cast("double")
    )


@F.pandas_udf(DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp ratio, which no built-in function computes; long names by the same rule as short ones."""
    return pd.Series([_ratio(x, y) for x, y in zip(a, b)], dtype="float64")


@F.pandas_udf(ArrayType(DoubleType()))
def sequence_ratios(a: pd.Series, b: pd.Series) -> pd.Series:
    """The ratios of the texts of two arrays, one by one."""
    return pd.Series([[_ratio(x, y) for x, y in zip(xs, ys)] for xs, ys in zip(a, b)], dtype="object")


def _ratio(x: str, y: str) -> float:
    return 1.0 if x == y else SequenceMatcher(None, x, y, autojunk=False).ratio()
