"""What the corpus operators share: table reading, shared-folder checkpoints, column names."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that separates words: space, tab, newline, vertical tab, form feed, carriage return.
SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared(spark: SparkSession) -> str:
    """The folder all executors share. Only a single-JVM session may do without the setting."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.gettempdir()
    return base.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared folder."""
    return f"{shared(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Compute now, keep the rows in the shared folder and cut the lineage.

    Spark removes the files once the frame is garbage (``cleanCheckpoints``)."""
    context = df.sparkSession.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(shared(df.sparkSession))
    return df.checkpoint(eager=True)


@contextmanager
def stored(spark: SparkSession) -> Iterator[Callable[..., DataFrame]]:
    """A function that keeps a frame as a table in the shared folder; the tables go with the context.

    For loops: a checkpoint keeps the size its plan was estimated at, which joins multiply round by round,
    while a table has the size of its files. What leaves the context must be cut from the tables."""
    folder, steps = scratch(spark, "steps"), []
    # As many files as keep all cores busy, not one per shuffle partition; few=False keeps the frame's partitions.
    tasks = 4 * spark.sparkContext.defaultParallelism

    def keep(df: DataFrame, *, few: bool = True) -> DataFrame:
        steps.append(f"{folder}/{len(steps)}")
        (df.coalesce(tasks) if few else df).write.parquet(steps[-1])
        return spark.read.schema(df.schema).parquet(steps[-1])

    try:
        yield keep
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like the given ones that the frame does not have yet."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def quoted(names: Iterable[str]) -> list[Column]:
    return [F.col(f"`{n}`") for n in names]


def words(text: Column) -> Column:
    """The words of a text: runs of anything but white space. NULL has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+"), "")
