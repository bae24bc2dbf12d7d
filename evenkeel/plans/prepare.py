"""Build one source table from several by a configured chain of joins."""

from __future__ import annotations

import json
from collections.abc import Mapping as Dict
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.load import load
from ..sources.save import settle

# Accepted spellings of join types. Joins always carry a key condition, so that a
# cross join with one is an inner join.
JOINS = {
    "inner": "inner",
    "cross": "inner",
    "left": "left",
    "leftouter": "left",
    "right": "right",
    "rightouter": "right",
    "full": "full",
    "outer": "full",
    "fullouter": "full",
    "semi": "left_semi",
    "leftsemi": "left_semi",
    "anti": "left_anti",
    "leftanti": "left_anti",
}
RESULT = "result"


@dataclass(frozen=True)
class JoinStep:
    left: str
    right: str
    left_key: str
    right_key: str
    type: str = "inner"

    @property
    def how(self) -> str:
        try:
            return JOINS[self.type.lower().replace("_", "")]
        except KeyError:
            raise ValueError(f"unknown join type {self.type!r}") from None


@dataclass(frozen=True)
class JoinPlan:
    """``select`` maps qualified columns (``table.column``) to output names, in output order."""

    steps: tuple[JoinStep, ...]
    select: Dict[str, str]
    sources: Dict[str, str] = field(default_factory=dict)
    target: str | None = None

    @property
    def tables(self) -> list[str]:
        names = [n for s in self.steps for n in (s.left, s.right) if n != RESULT]
        return list(dict.fromkeys(names))

    @classmethod
    def from_json(cls, document: str | dict | Path) -> JoinPlan:
        if isinstance(document, Path):
            document = document.read_text(encoding="utf-8")
        if isinstance(document, str):
            document = json.loads(document)
        document = document.get("multi_source_workflow", document)
        names = document["column_mapping"]
        steps = [
            JoinStep(s["left"], s["right"], s["left_key"], s["right_key"], s.get("type", "inner"))
            for s in document["join_steps"]
        ]
        return cls(
            steps=tuple(steps),
            select={c: names[c] for c in document["select_columns"]},
            sources={s["name"]: _reference(s) for s in document.get("sources", [])},
            target=_reference(document["target"]) if document.get("target") else None,
        )


def _reference(source: dict) -> str:
    if source.get("type") == "mysql":
        return f"jdbc:{source.get('table') or source.get('dbtable')}"
    return source.get("path") or f"table:{source['table']}"


def _qualified(df: DataFrame, table: str) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").alias(f"{table}.{c}") for c in df.columns])


def _left_key(joined: DataFrame, step: JoinStep, order: list[str]) -> str:
    """A key of the running result belongs to the first joined table that has it."""
    tables = order if step.left == RESULT else [step.left]
    for table in tables:
        if f"{table}.{step.left_key}" in joined.columns:
            return f"{table}.{step.left_key}"
    raise ValueError(f"no joined table has the key {step.left}.{step.left_key}")


def join_tables(tables: Dict[str, DataFrame], steps: tuple[JoinStep, ...]) -> DataFrame:
    """Fold the steps; result columns are named ``table.column``.

    A full join is written as a left join plus the right rows without partner: adaptive skew
    handling can split both of these, but no full outer join. What it uses twice is settled first if
    it is a join itself. A key of the result is that of the right table in rows that have no left one.
    """
    first = steps[0].left
    joined, order = _qualified(tables[first], first), [first]
    same: dict[str, list[str]] = {}
    for step in steps:
        right = _qualified(tables[step.right], step.right)
        left_name = _left_key(joined, step, order)
        right_name = f"{step.right}.{step.right_key}"
        used = [left_name, *(same.get(left_name, []) if step.left == RESULT else [])]
        if step.how == "full" and len(order) > 1:
            joined = settle(joined)
        on = F.coalesce(*[F.col(f"`{n}`") for n in used]) == F.col(f"`{right_name}`")
        if step.how == "full":
            alone = right.join(joined.select(*[f"`{n}`" for n in used]), on, "left_anti")
            joined = joined.join(right, on, "left").unionByName(alone, allowMissingColumns=True)
        else:
            joined = joined.join(right, on, step.how)
        if step.how in ("full", "right"):
            same.setdefault(left_name, []).append(right_name)
        order.append(step.right)
    return joined


def _shared_keys(steps: tuple[JoinStep, ...]) -> dict[str, str]:
    """Each table's key column in a chain of full joins on one shared key."""
    root = steps[0].left_key
    for number, step in enumerate(steps):
        if step.how != "full" or step.left_key != root or step.left != (RESULT if number else steps[0].left):
            raise ValueError("a chain of full joins on the key of the first table is wanted")
    keys = {steps[0].left: root, **{s.right: s.right_key for s in steps}}
    if len(keys) != len(steps) + 1:
        raise ValueError("a table can take part in the chain once only")
    return keys


def full_chain(tables: Dict[str, DataFrame], steps: tuple[JoinStep, ...]) -> DataFrame:
    """A chain of full joins on one shared key, in one shuffle of every table: the rows of ``join_tables``.

    All tables become one tagged union that is grouped by the key once. Keys that occur at most once in every
    table, as keys of lookup tables do, are put together by that; rows of other keys, whose partners
    multiply, go through the joins, which adaptive skew handling can split. A NULL key has no partner.
    """
    keys, parts = _shared_keys(steps), []
    names = {t: [f"{t}.{c}" for c in tables[t].columns] for t in keys}
    rows = {t: F.struct(*[F.col(f"`{c}`").alias(f"{t}.{c}") for c in tables[t].columns]) for t in keys}
    for name, key in keys.items():
        own = [
            (rows[n] if n == name else F.lit(None).cast(tables[n].select(rows[n].alias("r")).schema["r"].dataType)).alias(n)
            for n in keys
        ]
        tag = F.lit(name).alias("_tag")
        parts.append(tables[name].select(F.col(f"`{key}`").alias("_key"), tag, F.struct(*own).alias("_rows")))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionAll(part)
    flat = [F.col(f"_rows.`{t}`.`{c}`").alias(c) for t in keys for c in names[t]]
    lone = whole.filter("_key is null").select(*flat)
    counts = [F.count_if(F.col("_tag") == t).alias(f"_n{i}") for i, t in enumerate(keys)]
    # Where the key is put together here, at most one of its rows of each table is there.
    held = [F.first(F.col(f"_rows.`{t}`"), ignorenulls=True).alias(t) for t in keys]
    grouped = settle(whole.filter("_key is not null").groupBy("_key").agg(*counts, *held))
    most = F.greatest(*[F.col(f"_n{i}") for i in range(len(keys))])
    once = grouped.filter(most == 1).select(*[F.col(f"`{t}`.`{c}`").alias(c) for t in keys for c in names[t]])
    found = once.unionByName(lone)
    repeated = grouped.filter(most > 1).select("_key")
    if not repeated.isEmpty():
        few = {t: tables[t].join(repeated, F.col(f"`{key}`") == F.col("_key"), "left_semi") for t, key in keys.items()}
        found = found.unionByName(join_tables(few, steps))
    return found


def prepare(
    plan: JoinPlan, tables: Dict[str, DataFrame], target: DataFrame | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """The joined and renamed source, and the target's columns of the same names."""
    joined = join_tables({t: tables[t] for t in plan.tables}, plan.steps)
    source = joined.select(*[F.col(f"`{c}`").alias(n) for c, n in plan.select.items()])
    if target is not None:
        target = target.select(*[f"`{n}`" for n in plan.select.values()])
    return source, target


def prepare_from(spark: SparkSession, plan: JoinPlan, **options) -> tuple[DataFrame, DataFrame | None]:
    """``prepare`` over the sources the plan names; tables no step uses are not read."""
    tables = {t: load(spark, plan.sources[t], **options) for t in plan.tables}
    target = load(spark, plan.target, **options) if plan.target else None
    return prepare(plan, tables, target)


def route(config: dict) -> str:
    """Which way a job configuration goes: single_pair or multi_source."""
    kind = config.get("workflow_type", "single_pair")
    if kind not in ("single_pair", "multi_source"):
        raise ValueError(f"unknown workflow_type {kind!r}")
    return kind
