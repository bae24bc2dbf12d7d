"""Read tables from files, the catalog or a database, always by column name."""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.typed import typed
from ..mapping import Mapping
from .documents import documents_fail, layouts, read_documents, schema_of_documents

#: Up to so many documents, the JSON reader infers their schema without holding a whole one.
FEW = 32
SUFFIXES = {".csv": "csv", ".json": "json", ".parquet": "parquet"}
DECLARED = {
    "numeric": T.DecimalType(38, 10),
    "integer": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "string": T.StringType(),
}


def detect_format(ref: str) -> str:
    """csv, json, parquet, jdbc or table, by scheme or suffix."""
    for scheme in ("jdbc", "table"):
        if ref.startswith(f"{scheme}:"):
            return scheme
    suffix = PurePosixPath(ref.rstrip("/")).suffix.lower()
    if suffix in SUFFIXES:
        return SUFFIXES[suffix]
    raise ValueError(f"cannot tell the format of {ref!r}")


def read_csv(
    spark: SparkSession, path: str, infer: bool = False, multiline: bool = True
) -> DataFrame:
    """CSV with a header. Without ``infer`` all columns are text and no extra pass is made.

    With ``multiline`` a quoted value may hold newlines, and a file is read by one task; without it
    large files are split.
    """
    reader = spark.read.option("header", True).option("inferSchema", infer)
    return reader.option("escape", '"').option("multiLine", multiline).csv(path)


def read_json(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    multiline: bool | None = None,
) -> DataFrame:
    """JSON lines, or whole documents with ``multiline`` (one task per file).

    By default the first line of every file tells which, at the price of one more pass over the text: a whole
    object or array is a line, anything else begins a document, which must be one as a whole.
    """
    plain = spark.read.schema(schema) if schema else spark.read
    if multiline is not None:
        return plain.option("multiLine", multiline).json(path)
    text = spark.read.text(path)
    kinds = layouts(text)
    lines, documents, unclear = kinds.select(
        F.count_if("by_line"), F.count_if(~F.col("by_line")), F.count_if(~F.col("by_line") & ~F.col("begun"))
    ).first()
    if unclear and (bad := [r.file for r in documents_fail(text).limit(5).collect()]):
        raise ValueError(f"neither JSON lines nor a document: {bad}; say which with multiline")
    if lines and documents:
        return read_documents(spark, path, schema, text)
    if documents > FEW and schema is None:
        plain = spark.read.schema(schema_of_documents(spark, path))
    return plain.option("multiLine", bool(documents)).json(path)


def read_parquet(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    return spark.read.option("mergeSchema", merge_schema).parquet(path)


def jdbc_options(
    url: str,
    table: str,
    *,
    split_by: str | None = None,
    bounds: tuple[int, int] | None = None,
    splits: int = 1,
    **options: str,
) -> dict[str, str]:
    """Options of a database read; ``split_by`` with ``bounds`` reads it in ``splits`` queries."""
    chosen = {"url": url, "dbtable": table, **options}
    if split_by:
        if bounds is None:
            raise ValueError("a split read needs the bounds of its column")
        chosen |= {
            "partitionColumn": split_by,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(splits),
        }
    return chosen


def read_jdbc(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **options)).load()


def declared_schema(mapping: Mapping, side: str) -> T.StructType:
    """The mapped columns of one side in their declared types."""
    return T.StructType([T.StructField(c.on(side), DECLARED[c.kind]) for c in mapping.columns])


def to_declared(df: DataFrame, mapping: Mapping, side: str) -> DataFrame:
    """Mapped columns cast to their declared types, found by name; absent columns are NULL."""
    have = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *[
            (
                typed(F.col(f"`{c.on(side)}`"), c.kind, c.date_format, have[c.on(side)])
                if c.on(side) in have
                else F.lit(None).cast(c.spark_type)
            ).alias(c.on(side))
            for c in mapping.columns
        ]
    )


def read_declared(
    spark: SparkSession, ref: str, mapping: Mapping, side: str, **options
) -> DataFrame:
    """A table in the types its mapping declares; values that do not fit are NULL."""
    if detect_format(ref) == "json":
        text = T.StructType([T.StructField(c.on(side), T.StringType()) for c in mapping.columns])
        return to_declared(read_json(spark, ref, text, **options), mapping, side)
    return to_declared(load(spark, ref, **options), mapping, side)


def load(spark: SparkSession, ref: str, fmt: str | None = None, **options) -> DataFrame:
    """Read ``ref``: a path by its suffix, ``table:name`` or ``jdbc:table`` (with ``url=``).

    ``fmt`` names the format of a path without suffix.
    """
    kind = fmt or detect_format(ref)
    if kind == "table":
        return spark.table(ref.removeprefix("table:"))
    if kind == "jdbc":
        return read_jdbc(spark, table=ref.removeprefix("jdbc:"), **options)
    return {"csv": read_csv, "json": read_json, "parquet": read_parquet}[kind](spark, ref, **options)
