"""Make the target agree with the source: update, insert and delete rows.

A source key with several rows counts with its least row. Every target row is compared on its own,
so all copies of a duplicated target key are repaired.

Source rows are reduced to one per key and stored in the shared folder; all target rows are then joined to
that table from the left, and the keys the target lacks are found by an anti join. Both joins read plain
shuffles, so adaptive execution can split a key that holds most rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.normalize import differs, plain
from ..functions.typed import typed
from ..mapping import ColumnMap, Mapping
from ..sources.save import settle
from .classify import key_columns, key_exprs, keyed, survivors


def _source_rows(source: DataFrame, mapping: Mapping, null_keys: str = "equal") -> DataFrame:
    """One row per key, stored."""
    rows = keyed(source, mapping, "source", null_keys=null_keys)
    return settle(survivors(rows, key_columns(mapping, null_keys), "n_src", "src").drop("n_src"))


def _target_rows(target: DataFrame, mapping: Mapping, null_keys: str = "equal") -> DataFrame:
    row = F.struct(*[F.col(f"`{c}`") for c in target.columns])
    return target.select(*key_exprs(target, mapping, "target", null_keys), row.alias("tgt"))


class _Row:
    """Expressions over a frame with ``src`` (common names) and ``tgt`` (target names) structs."""

    def __init__(self, source: DataFrame, target: DataFrame, mapping: Mapping, null_update: str):
        if null_update not in ("keep", "overwrite"):
            raise ValueError(f"null_update must be 'keep' or 'overwrite', not {null_update!r}")
        self.source, self.target, self.mapping = source.schema, target.schema, mapping
        self.null_update = null_update
        self.mapped = {c.target: c for c in mapping.columns}

    def raw(self, column: ColumnMap) -> Column:
        return F.col("src").getField(self.mapping.name(column))

    def differs(self, c: ColumnMap) -> Column:
        own, other = self.source[c.source].dataType, self.target[c.target].dataType
        left = self.raw(c)
        right = plain(F.col("tgt").getField(c.target), other)
        own = T.StringType() if isinstance(own, (T.StructType, T.ArrayType, T.MapType)) else own
        other = T.StringType() if isinstance(other, (T.StructType, T.ArrayType, T.MapType)) else other
        return differs(left, right, c.kind, c.date_format, own, other, self.mapping.unfit)

    def changed(self) -> Column:
        flags = [F.when(self.differs(c), F.lit(self.mapping.name(c))) for c in self.mapping.compare]
        return F.array_compact(F.array(*flags)) if flags else F.array().cast("array<string>")

    def from_source(self, c: ColumnMap) -> Column:
        """The source value in the type of the target column."""
        own, wanted = self.source[c.source].dataType, self.target[c.target].dataType
        value = self.raw(c)
        if isinstance(wanted, (T.StructType, T.ArrayType, T.MapType)):
            return F.from_json(value, wanted)
        if own == wanted or isinstance(wanted, T.StringType):
            return value.cast(wanted)
        return typed(value, c.kind, c.date_format, own).try_cast(wanted)

    def updated(self, c: ColumnMap) -> Column:
        old, new = F.col("tgt").getField(c.target), self.from_source(c)
        return F.coalesce(new, old) if self.null_update == "keep" else new

    def corrected(self, forced: set[str] | None = None) -> list[Column]:
        """The target row with its differing values replaced.

        ``forced`` names columns to overwrite in every changed row, whatever differs in it.
        """
        columns = []
        for name in self.target.names:
            old, c = F.col("tgt").getField(name), self.mapped.get(name)
            if c is None or c in self.mapping.keys:
                columns.append(old.alias(name))
                continue
            if forced is None:
                flag = F.array_contains("changed", self.mapping.name(c))
            else:
                flag = F.size("changed") > 0 if self.mapping.name(c) in forced else F.lit(False)
            columns.append(F.when(flag, self.updated(c)).otherwise(old).alias(name))
        return columns

    def inserted(self) -> list[Column]:
        return [
            (
                self.from_source(self.mapped[f.name])
                if f.name in self.mapped
                else F.lit(None).cast(f.dataType)
            ).alias(f.name)
            for f in self.target.fields
        ]


def update_rows(
    target: DataFrame,
    source: DataFrame,
    mapping: Mapping,
    *,
    null_update: str = "keep",
    scope: str = "row",
    null_keys: str = "equal",
) -> DataFrame:
    """Replace differing values of matched target rows by the source's.

    ``null_update="keep"`` leaves values alone that are NULL in the source. ``scope="union"``
    overwrites, in every changed row, all columns that differ in any row. With ``null_keys="distinct"`` rows
    with a NULL in their key match none.
    """
    row = _Row(source, target, mapping, null_update)
    own = _source_rows(source, mapping, null_keys)
    joined = _target_rows(target, mapping, null_keys).join(own, key_columns(mapping, null_keys), "left")
    changed = F.when(F.col("src").isNotNull(), row.changed()).otherwise(
        F.array().cast("array<string>")
    )
    joined = joined.withColumn("changed", changed)
    forced = None
    if scope == "union":
        flags = [
            F.bool_or(F.array_contains("changed", n)).alias(f"c{i}")
            for i, n in enumerate(mapping.compare_names)
        ]
        seen = joined.agg(*flags).first() if flags else ()
        forced = {n for n, hit in zip(mapping.compare_names, seen) if hit}
    elif scope != "row":
        raise ValueError(f"scope must be 'row' or 'union', not {scope!r}")
    return joined.select(*row.corrected(forced))


def insert_rows(
    target: DataFrame, source: DataFrame, mapping: Mapping, null_keys: str = "equal"
) -> DataFrame:
    """Add the source rows whose key the target lacks."""
    known = target.select(*key_exprs(target, mapping, "target", null_keys)).distinct()
    missing = _source_rows(source, mapping, null_keys).join(known, key_columns(mapping, null_keys), "left_anti")
    row = _Row(source, target, mapping, "keep")
    return target.unionByName(missing.select(*row.inserted()))


def delete_rows(
    target: DataFrame, source: DataFrame, mapping: Mapping, null_keys: str = "equal"
) -> DataFrame:
    """Remove the target rows whose key the source lacks."""
    known = settle(source.select(*key_exprs(source, mapping, "source", null_keys)).distinct())
    kept = _target_rows(target, mapping, null_keys).join(known, key_columns(mapping, null_keys), "left_semi")
    return kept.select("tgt.*")


def plan_repair(
    target: DataFrame,
    source: DataFrame,
    mapping: Mapping,
    *,
    null_update: str = "keep",
    null_keys: str = "equal",
) -> DataFrame:
    """Every row of the repair: what happens to it and the columns of the target.

    ``_action`` is keep, update, insert or delete, ``_changed`` names the replaced columns, ``_stays``
    is false for deleted rows only and costs no comparison of values.
    With ``null_keys="distinct"`` rows with a NULL in their key are no partners: those of the source are
    inserted and those of the target deleted.
    """
    keys = key_columns(mapping, null_keys)
    row = _Row(source, target, mapping, null_update)
    own = _source_rows(source, mapping, null_keys)
    others = _target_rows(target, mapping, null_keys)
    alone = own.join(others.select(*keys).distinct(), keys, "left_anti")
    joined = others.join(own, keys, "left").unionByName(alone, allowMissingColumns=True)
    nothing = F.array().cast("array<string>")
    both = F.col("src").isNotNull() & F.col("tgt").isNotNull()
    joined = joined.withColumn("changed", F.when(both, row.changed()).otherwise(nothing))
    action = (
        F.when(F.col("tgt").isNull(), "insert")
        .when(F.col("src").isNull(), "delete")
        .when(F.size("changed") > 0, "update")
        .otherwise("keep")
    )
    values = [
        F.when(F.col("tgt").isNull(), new).otherwise(old).alias(name)
        for name, old, new in zip(target.columns, row.corrected(), row.inserted())
    ]
    return joined.select(
        action.alias("_action"),
        F.col("changed").alias("_changed"),
        F.col("src").isNotNull().alias("_stays"),
        *values,
    )


def repaired(plan: DataFrame) -> DataFrame:
    """The target after the repair."""
    return plan.filter("_stays").drop("_action", "_changed", "_stays")


def repair_summary(plan: DataFrame) -> DataFrame:
    """Row counts before and after, and how many rows and values were touched."""
    act = F.col("_action")
    totals = plan.agg(
        F.count_if(act != "insert").alias("initial_target_count"),
        F.count_if(act != "delete").alias("final_target_count"),
        F.count_if(act == "update").alias("total_updates"),
        F.coalesce(F.sum(F.size("_changed")), F.lit(0)).alias("total_column_updates"),
        F.count_if(act == "insert").alias("total_inserts"),
        F.count_if(act == "delete").alias("total_deletes"),
    )
    net = F.col("final_target_count") - F.col("initial_target_count")
    return totals.withColumn("net_change", net)


def repair_details(plan: DataFrame, mapping: Mapping, action: str) -> DataFrame:
    """Keys of all repaired rows, for updates with the changed columns."""
    keys = [F.col(f"`{c.target}`").alias(mapping.name(c)) for c in mapping.keys]
    rows = plan.filter(F.col("_action") == action)
    columns = F.array_join("_changed", ",").alias("updated_columns")
    return rows.select(*keys, columns) if action == "update" else rows.select(*keys)


def upsert_by_key(
    existing: DataFrame,
    incoming: DataFrame,
    keys: list[str],
) -> DataFrame:
    """Rows of a keyed table after writing ``incoming`` into it; nothing is deleted.

    Incoming rows replace existing ones of the same key; of several, the least row counts. A NULL in a
    key is a value like others.
    """
    names = [F.col(f"`{c}`") for c in existing.columns]
    # Structs are equal where both have a NULL.
    key = F.struct(*[F.col(f"`{c}`") for c in keys]).alias("key")
    new = settle(incoming.groupBy(key).agg(F.min(F.struct(*names)).alias("row")))
    rows = existing.select(key, F.struct(*names).alias("row"))
    kept = rows.join(new.select("key"), "key", "left_anti")
    return kept.select("row.*").unionByName(new.select("row.*"))
