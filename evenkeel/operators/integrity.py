"""Foreign keys and rule tables: any number of checks from one pass over each table."""

from __future__ import annotations

from collections.abc import Iterable
from collections.abc import Mapping as Dict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.save import settle
from .small import small_frame


@dataclass(frozen=True)
class ForeignKey:
    """Columns of a child table whose values must occur in columns of a parent table."""

    name: str
    child: str
    child_columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


def _value(columns: tuple[str, ...]) -> Column:
    return F.array(*[F.col(f"`{c}`").cast("string") for c in columns])


def _whole(columns: tuple[str, ...]) -> Column:
    found = F.lit(True)
    for c in columns:
        found = found & F.col(f"`{c}`").isNotNull()
    return found


def _values(tables: Dict[str, DataFrame], keys: Iterable[ForeignKey]) -> DataFrame:
    """(constraint, value, child_rows, is_parent): every constraint's values of both sides, counted.

    Each table is read once for all constraints that name it. Values are counted before the one shuffle,
    so a value that most rows share costs a row per task.
    """
    entries: dict[str, list[Column]] = {}
    for number, key in enumerate(keys):
        if len(key.child_columns) != len(key.parent_columns):
            raise ValueError(f"{key.name} pairs {len(key.child_columns)} with {len(key.parent_columns)} columns")
        for name, columns, child in ((key.child, key.child_columns, 1), (key.parent, key.parent_columns, 0)):
            entries.setdefault(name, []).append(
                F.struct(
                    F.lit(number).alias("constraint"),
                    F.when(_whole(columns), _value(columns)).alias("value"),
                    F.lit(child).cast("bigint").alias("child"),
                )
            )
    parts = [tables[name].select(F.inline(F.array(*found))) for name, found in entries.items()]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionAll(part)
    whole = whole.filter("value is not null or child = 1")
    return whole.groupBy("constraint", "value").agg(
        F.sum("child").alias("child_rows"), (F.min("child") == 0).alias("is_parent")
    )


def referential_integrity(tables: Dict[str, DataFrame], keys: list[ForeignKey]) -> DataFrame:
    """One row per constraint: checked and NULL rows, values and rows without a parent, status.

    A NULL in any column of the key refers to nothing and is no orphan.
    """
    values = _values(tables, keys)
    null, orphan = F.col("value").isNull(), F.col("value").isNotNull() & ~F.col("is_parent")
    rows = F.col("child_rows")
    totals = values.groupBy("constraint").agg(
        F.sum(F.when(~null, rows).otherwise(0)).alias("checked_rows"),
        F.sum(F.when(null, rows).otherwise(0)).alias("null_rows"),
        F.count_if(orphan).alias("orphan_values"),
        F.sum(F.when(orphan, rows).otherwise(0)).alias("orphan_rows"),
    )
    named = small_frame(
        values.sparkSession,
        [(i, k.name, k.child, k.parent) for i, k in enumerate(keys)],
        "constraint int, constraint_name string, child_table string, parent_table string",
    )
    found = named.join(totals, "constraint", "left")
    counters = ["checked_rows", "null_rows", "orphan_values", "orphan_rows"]
    shown = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counters]
    status = F.when(F.coalesce("orphan_rows", F.lit(0)) > 0, "FAIL").otherwise("PASS").alias("status")
    return found.select("constraint_name", "child_table", "parent_table", *shown, status)


def orphan_values(tables: Dict[str, DataFrame], keys: list[ForeignKey]) -> DataFrame:
    """constraint_name, value (its columns as an array of texts) and the child rows that hold it."""
    found = _values(tables, keys).filter("value is not null and not is_parent")
    names = F.array(*[F.lit(k.name) for k in keys])
    return found.select(names[F.col("constraint")].alias("constraint_name"), "value", F.col("child_rows").alias("orphan_rows"))


def orphan_rows(tables: Dict[str, DataFrame], keys: list[ForeignKey], name: str) -> DataFrame:
    """The child rows of one constraint that have no parent, with all their columns.

    The values without a parent are stored first: few are then known to be few and broadcast, and with many of them
    the rows come straight from their shuffle, so that adaptive execution can split a value that most rows share.
    """
    key = next(k for k in keys if k.name == name)
    lost = settle(_values(tables, [key]).filter("value is not null and not is_parent").select(F.col("value").alias("_value")))
    child = tables[key.child]
    return child.join(lost, _value(key.child_columns) == F.col("_value"), "left_semi")


#: Kinds of rules. The last ones judge one number of the whole column, the others every value.
VALUE_RULES = ("not_null", "min", "max", "range", "pattern", "in_set", "length")
TABLE_RULES = ("row_count", "sum", "avg", "minimum", "maximum", "approx_distinct")


@dataclass(frozen=True)
class Rule:
    """One line of a rule table.

    ``not_null`` to ``length`` count the values that break the rule and fail if their share exceeds
    ``tolerance``: NULLs; values below ``low``; above ``high``; outside both; not matched as a whole by
    ``pattern``; not among ``allowed``; texts shorter than ``low`` or longer than ``high``. NULL breaks none but
    the first. ``row_count`` to ``approx_distinct`` fail if the column's number is below ``low`` or above ``high``.
    """

    rule_id: str
    table: str
    column: str | None
    kind: str
    low: float | str | None = None
    high: float | str | None = None
    pattern: str | None = None
    allowed: tuple | None = None
    tolerance: float = 0.0

    def __post_init__(self) -> None:
        if self.kind not in VALUE_RULES + TABLE_RULES:
            raise ValueError(f"unknown kind of rule {self.kind!r} in {self.rule_id}")


def rules_from(frame: DataFrame) -> list[Rule]:
    """Rules from a table with the fields of ``Rule`` as columns; a table of rules is small metadata."""
    fields = [f for f in Rule.__dataclass_fields__ if f in frame.columns]
    rows = []
    for r in frame.select(*fields).collect():
        given = {f: r[f] for f in fields if r[f] is not None}
        if "allowed" in given:
            given["allowed"] = tuple(given["allowed"])
        rows.append(Rule(**{"column": None, **given}))
    return rows


def _bound(value: float | str, dtype) -> Column:
    return F.lit(value).cast(dtype)


def _broken(rule: Rule, df: DataFrame) -> Column:
    """Whether a value breaks its rule; NULL where that cannot be told."""
    c, dtype = F.col(f"`{rule.column}`"), df.schema[rule.column].dataType
    if rule.kind == "not_null":
        return c.isNull()
    if rule.kind == "pattern":
        return ~c.cast("string").rlike(rf"\A(?:{rule.pattern})\z")
    if rule.kind == "in_set":
        return ~c.isin(*[_bound(v, dtype) for v in rule.allowed])
    value, dtype = (F.length(c.cast("string")), "bigint") if rule.kind == "length" else (c, dtype)
    broken = F.lit(False)
    if rule.low is not None and rule.kind != "max":
        broken = broken | (value < _bound(rule.low, dtype))
    if rule.high is not None and rule.kind != "min":
        broken = broken | (value > _bound(rule.high, dtype))
    return broken


def _number(rule: Rule) -> Column:
    if rule.kind == "row_count":
        return F.count(F.lit(1)).cast("double")
    c = F.col(f"`{rule.column}`")
    if rule.kind in ("sum", "avg"):  # decimals add up to the same number in any order
        total = F.sum(c.cast("decimal(38,6)")).cast("double")
        return total if rule.kind == "sum" else total / F.nullif(F.count(c), F.lit(0))
    if rule.kind == "approx_distinct":
        return F.approx_count_distinct(c, 0.01).cast("double")
    return (F.min(c) if rule.kind == "minimum" else F.max(c)).cast("double")


def apply_rules(tables: Dict[str, DataFrame], rules: list[Rule]) -> DataFrame:
    """One row per rule: rule_id, table_name, column_name, rule_kind, checked_rows, failed_rows, value, status.

    All rules of a table become one aggregate, so every table is read once. A rule on a table or column that
    is not there is SKIPPED. ``value`` is the number a table rule judges.
    """
    spark = next(iter(tables.values())).sparkSession
    none = F.lit(None)
    parts: list[DataFrame] = []
    skipped = []
    by_table: dict[str, list[Rule]] = {}
    for rule in rules:
        df = tables.get(rule.table)
        if df is None or (rule.column is None and rule.kind != "row_count") or (rule.column is not None and rule.column not in df.columns):
            skipped.append((rule.rule_id, rule.table, rule.column, rule.kind))
        else:
            by_table.setdefault(rule.table, []).append(rule)
    for name, own in by_table.items():
        df = tables[name]
        totals = df.agg(
            F.count(F.lit(1)).alias("rows"),
            *[(F.count_if(_broken(r, df)) if r.kind in VALUE_RULES else _number(r)).alias(f"r{i}") for i, r in enumerate(own)],
        )
        lines = []
        for i, r in enumerate(own):
            found = F.col(f"r{i}")
            if r.kind in VALUE_RULES:
                failed, value = found, none.cast("double")
                bad = found > F.lit(r.tolerance) * F.col("rows")
            else:
                value, bad = found, F.lit(False)
                if r.low is not None:
                    bad = bad | (found < F.lit(float(r.low)))
                if r.high is not None:
                    bad = bad | (found > F.lit(float(r.high)))
                bad = F.coalesce(bad, F.lit(True))  # no number to judge, as of an empty column
                failed = none
            lines.append(
                F.struct(
                    F.lit(r.rule_id).alias("rule_id"), F.lit(name).alias("table_name"), F.lit(r.column).cast("string").alias("column_name"),
                    F.lit(r.kind).alias("rule_kind"), F.col("rows").alias("checked_rows"), failed.cast("bigint").alias("failed_rows"),
                    value.alias("value"), F.when(bad, "FAIL").otherwise("PASS").alias("status"),
                )
            )
        parts.append(totals.select(F.inline(F.array(*lines))))
    if skipped:
        frame = small_frame(spark, skipped, "rule_id string, table_name string, column_name string, rule_kind string")
        parts.append(
            frame.select(
                "*", none.cast("bigint").alias("checked_rows"), none.cast("bigint").alias("failed_rows"),
                none.cast("double").alias("value"), F.lit("SKIPPED").alias("status"),
            )
        )
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
