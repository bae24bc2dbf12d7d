"""Write results. One file per task unless a single file is asked for."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping as Dict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.normalize import plain
from ..mapping import Mapping

FORMATS = ("csv", "json", "parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder name below the shared folder of ``spark.checkpoint.dir``.

    Only in a single JVM, as in tests, may it be unset: then a local temporary folder is made.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="evenkeel-")
    return f"{base.rstrip('/')}/evenkeel-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Write a frame to the shared folder and read it back, which cuts its lineage."""
    path = f"{scratch(df.sparkSession)}.parquet"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def save(
    df: DataFrame, path: str, fmt: str = "parquet", *, single: bool = False, mode: str = "error"
) -> str:
    """Write csv (header, NULL as empty), json (NULL fields kept) or parquet.

    ``single`` gives one file through one task; it is meant for small reports.
    """
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}")
    writer = (df.coalesce(1) if single else df).write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True).option("nullValue", "").option("emptyValue", "")
        writer = writer.option("escape", '"').option("ignoreLeadingWhiteSpace", False)
        writer = writer.option("ignoreTrailingWhiteSpace", False)
    elif fmt == "json":
        writer = writer.option("ignoreNullFields", False)
    writer.format(fmt).save(path)
    if fmt == "csv" and not single and df.sparkSession.read.text(path).isEmpty():
        # Nothing was written, not even the header.
        empty = df.sparkSession.createDataFrame([], df.schema).repartition(1)
        save(empty, path, fmt, single=True, mode="overwrite")
    return path


def as_text(df: DataFrame, mapping: Mapping | None = None, side: str = "target") -> DataFrame:
    """Columns as a text file can hold them: dates by their declared pattern, else ISO; nested as JSON."""
    patterns = {c.on(side): c.date_format for c in mapping.columns} if mapping else {}
    columns = []
    for f in df.schema.fields:
        value = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            value = F.date_format(value, patterns.get(f.name) or "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            value = F.date_format(value, patterns.get(f.name) or "yyyy-MM-dd HH:mm:ss")
        else:
            value = plain(value, f.dataType)
        columns.append(value.alias(f.name))
    return df.select(*columns)


def save_reconciled(
    df: DataFrame, path: str, fmt: str, mapping: Mapping | None = None, *, mode: str = "error"
) -> str:
    """Write a repaired target in the target's own format; text formats get readable dates."""
    return save(df if fmt == "parquet" else as_text(df, mapping), path, fmt, mode=mode)


def save_bundle(frames: Dict[str, DataFrame], base: str, fmt: str = "parquet") -> dict[str, str]:
    """Write several named frames below one folder."""
    return {n: save(df, f"{base.rstrip('/')}/{n}", fmt) for n, df in frames.items()}


def backup(spark: SparkSession, path: str, to: str, fmt: str = "parquet") -> str:
    """Copy a stored table before it is overwritten."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("escape", '"').option("multiLine", True)
    return save(reader.load(path), to, fmt)
