"""Tables stored by key hash, whose partitions are rewritten only where something changes.

A row's partition is the hash of its key, modulo a fixed number. An upsert reads and rewrites the partitions
that incoming keys fall into, a repair those whose digests differ from the source's; the files of all others
stay as they are. New partitions are written to the shared folder first and then take the place of the old
ones (dynamic partition overwrite), so a job that dies before can be run again from the same input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..mapping import Mapping
from ..operators.classify import key_columns, key_exprs
from ..operators.digest import canonical, digests
from ..operators.repair import plan_repair, repaired, upsert_by_key
from .save import settle

PART = "_part"
PARTS = 256


def _part(parts: int, keys: list[Column]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")


def _names(keys: list[str]) -> list[Column]:
    return [F.col(f"`{k}`") for k in keys]


def _target_part(df: DataFrame, mapping: Mapping, side: str, parts: int) -> Column:
    """The partition by canonical key, the same for both sides of a mapping."""
    return _part(parts, key_exprs(df, mapping, side))


def _put(rows: DataFrame, path: str, mode: str) -> None:
    # One task per partition would not do for a hot key: rows of a partition are dealt by their own hash too.
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns if c != PART]), F.lit(4))
    dealt = rows.repartition(PART, spread)
    dealt.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(path)


def _stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _drop(spark: SparkSession, path: str, parts: list[int]) -> None:
    """Remove partitions of which no row is left; a dynamic overwrite only replaces."""
    for part in parts:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{PART}={part}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write_keyed(df: DataFrame, path: str, keys: list[str], *, parts: int = PARTS) -> str:
    """Store a table by the hash of its key columns, for ``upsert_stored``."""
    _put(df.withColumn(PART, _part(parts, _names(keys))), path, "error")
    return path


def write_target(df: DataFrame, path: str, mapping: Mapping, *, parts: int = PARTS) -> str:
    """Store the target of a mapping by the hash of its canonical key, for ``repair_stored``."""
    _put(df.withColumn(PART, _target_part(df, mapping, "target", parts)), path, "error")
    return path


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a stored table."""
    return _stored(spark, path).drop(PART)


def _replace(spark: SparkSession, path: str, rows: DataFrame, touched: list[int]) -> None:
    """Put the new rows of the touched partitions in place of the old ones."""
    new = settle(rows)
    left = {r[0] for r in new.select(PART).distinct().collect()}  # at most the number of partitions
    _put(new, path, "overwrite")
    _drop(spark, path, [p for p in touched if p not in left])


def upsert_stored(path: str, incoming: DataFrame, keys: list[str], *, parts: int = PARTS) -> list[int]:
    """Write incoming rows into a table of ``write_keyed``; returns the partitions that were rewritten."""
    spark = incoming.sparkSession
    dealt = incoming.withColumn(PART, _part(parts, _names(keys)))
    touched = sorted(r[0] for r in dealt.select(PART).distinct().collect())  # at most ``parts`` numbers
    if touched:
        existing = _stored(spark, path).filter(F.col(PART).isin(touched))
        merged = upsert_by_key(existing.drop(PART), incoming.select(*_names(existing.drop(PART).columns)), keys)
        _replace(spark, path, merged.withColumn(PART, _part(parts, _names(keys))), touched)
    return touched


def _partition_sums(df: DataFrame, mapping: Mapping, side: str, part: Column) -> DataFrame:
    """Rows and digest sums per partition, added up before the shuffle."""
    rows = df.select(part.alias(PART), *key_exprs(df, mapping, side), F.array(*canonical(df, mapping, side)).alias("v"))
    rows = rows.select(PART, *digests(*[F.col(k) for k in key_columns(mapping)], F.col("v")))
    low = F.lit(0xFFFFFFFF).cast("bigint")
    halves = [half for d in ("d1", "d2") for half in (F.col(d).bitwiseAND(low), F.shiftrightunsigned(d, 32))]
    return rows.groupBy(PART).agg(F.struct(F.count(F.lit(1)).alias("n"), *[F.sum(h).alias(f"s{i}") for i, h in enumerate(halves)]).alias(side))


def repair_stored(
    path: str, source: DataFrame, mapping: Mapping, *, null_update: str = "keep", parts: int = PARTS
) -> list[int]:
    """Repair a table of ``write_target`` from the source; returns the partitions that were rewritten.

    Partitions that hold the same bag of canonical rows on both sides need no repair: they are not touched,
    nor are their rows exchanged.
    """
    spark = source.sparkSession
    target = _stored(spark, path)
    own = _partition_sums(source, mapping, "source", _target_part(source, mapping, "source", parts))
    other = _partition_sums(target, mapping, "target", F.col(PART))
    both = own.join(other, PART, "full_outer").filter(~F.col("source").eqNullSafe(F.col("target")))
    touched = sorted(r[0] for r in both.select(PART).collect())  # at most ``parts`` numbers
    if touched:
        old = target.filter(F.col(PART).isin(touched)).drop(PART)
        new = source.filter(_target_part(source, mapping, "source", parts).isin(touched))
        fixed = repaired(plan_repair(old, new, mapping, null_update=null_update))
        _replace(spark, path, fixed.withColumn(PART, _target_part(fixed, mapping, "target", parts)), touched)
    return touched
