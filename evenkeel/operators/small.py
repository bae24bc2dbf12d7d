"""Frames of a few rows of metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def small_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """The rows as literals in one partition, not spread over as many tasks as the cluster has cores."""
    fields = T.StructType.fromDDL(schema).fields
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields)])
        for row in rows
    ]
    if not structs:
        columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in fields]
        return spark.range(0, 0, 1, 1).select(*columns)
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))
