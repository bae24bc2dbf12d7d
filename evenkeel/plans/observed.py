"""Checks as a by-product of writing: the pass that stores a result counts it too.

Counters are observed where rows are written, in the last stage of a job, which counts every task once
even when executors are lost and earlier stages run again. What is counted per input row, such as values that do not fit
their type, is therefore added up per key and carried to that stage along with the key's row.
"""

from __future__ import annotations

import datetime as dt
import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.normalize import plain
from ..functions.typed import cast_fails
from ..mapping import ColumnMap, Mapping
from ..operators import checks as C
from ..operators import drift
from ..operators.classify import changed_columns, key_columns, key_exprs, slim
from ..operators.small import small_frame
from ..sources.save import save, save_reconciled
from .validation import Validation

def _or_none(count: Column) -> Column:
    return F.coalesce(count, F.lit(0).cast("bigint"))


def save_observed(
    df: DataFrame, path: str, counters: dict[str, Column], fmt: str = "parquet", *, mode: str = "error", write=save
) -> dict[str, int]:
    """Write a frame and return the counters of its rows, without reading anything twice."""
    seen = Observation()
    watched = df.observe(seen, *[c.alias(n) for n, c in counters.items()])
    write(watched, path, fmt, mode=mode)
    return seen.get


def null_counters(df: DataFrame, prefix: str = "", among: Column | None = None) -> dict[str, Column]:
    """NULLs of every column, among the rows for which ``among`` holds."""
    chosen = F.lit(True) if among is None else among
    return {f"{prefix}{c}": F.count_if(F.col(f"`{c}`").isNull() & chosen) for c in df.columns}


@dataclass
class SavedRepair:
    summary: DataFrame
    null_counts: DataFrame
    seconds: float


def save_repair(
    plan: DataFrame, path: str, fmt: str = "parquet", mapping: Mapping | None = None, *, mode: str = "error"
) -> SavedRepair:
    """Write the repaired target; the totals of the repair and its NULLs per column come with the write."""
    act, started = F.col("_action"), time.monotonic()
    target = [c for c in plan.columns if c not in ("_action", "_changed", "_stays")]
    totals = {
        "initial_target_count": F.count_if(act != "insert"),
        "final_target_count": F.count_if(act != "delete"),
        "total_updates": F.count_if(act == "update"),
        "total_column_updates": _or_none(F.sum(F.size("_changed").cast("bigint"))),
        "total_inserts": F.count_if(act == "insert"),
        "total_deletes": F.count_if(act == "delete"),
    }

    def write(watched: DataFrame, path: str, fmt: str, *, mode: str) -> None:
        save_reconciled(watched.filter("_stays").select(*[f"`{c}`" for c in target]), path, fmt, mapping, mode=mode)

    counters = totals | null_counters(plan.select(*[f"`{c}`" for c in target]), "null:", F.col("_stays"))
    found = save_observed(plan, path, counters, fmt, mode=mode, write=write)
    row = [found[n] for n in totals]
    spark = plan.sparkSession
    return SavedRepair(
        summary=small_frame(
            spark, [(*row, row[1] - row[0])], ", ".join(f"{n} bigint" for n in [*totals, "net_change"])
        ),
        null_counts=small_frame(
            spark, [(c, found[f"null:{c}"]) for c in target], "column_name string, null_count bigint"
        ),
        seconds=time.monotonic() - started,
    )


def _side(
    df: DataFrame, mapping: Mapping, side: str, null_keys: str, row: str, count: str, typed: list[ColumnMap]
) -> DataFrame:
    """One row per key with its row count and, per typed column, the number of values that do not fit."""
    fields = df.schema
    whole = F.struct(
        *[plain(F.col(f"`{c.on(side)}`"), fields[c.on(side)].dataType).alias(mapping.name(c)) for c in mapping.columns]
    )
    fails = [
        cast_fails(F.col(f"`{c.on(side)}`"), c.kind, c.date_format, fields[c.on(side)].dataType).alias(f"_f{i}")
        for i, c in enumerate(typed)
    ]
    rows = df.select(*key_exprs(df, mapping, side, null_keys), whole.alias("row"), *fails)
    unfit = F.array(*[F.count_if(f"_f{i}") for i in range(len(typed))]) if typed else F.array().cast("array<bigint>")
    return rows.groupBy(*key_columns(mapping, null_keys)).agg(
        F.count(F.lit(1)).alias(count), F.min("row").alias(row), unfit.alias(f"{row}_unfit")
    )


@dataclass
class SavedValidation:
    summary: DataFrame
    checks: DataFrame
    compared: DataFrame
    mapping: Mapping
    locations: dict[str, str]


def save_validation(
    source: DataFrame,
    target: DataFrame,
    mapping: Mapping,
    base: str,
    *,
    null_keys: str = "equal",
    drift_rule: str = "typed",
    strict: bool = True,
    details: bool = True,
) -> SavedValidation:
    """Compare, store the comparison below ``base`` and report; both tables are read once.

    Details are read off the stored comparison. The summary has the checks' counters and states, the number
    of partitions of both plans, when the run was, how long it took and where its details are.
    """
    started, stamp = time.monotonic(), dt.datetime.now(dt.timezone.utc)
    run = Validation(source, target, mapping, null_keys=null_keys, drift_rule=drift_rule, strict=strict)
    own = run.compared
    typed = {
        side: [c for c in mapping.columns if c.kind != "string" and c.on(side) not in run.missing[side]]
        for side in ("source", "target")
    }
    left = _side(source, own, "source", null_keys, "src", "n_src", typed["source"])
    right = _side(target, own, "target", null_keys, "tgt", "n_tgt", typed["target"])
    keys = key_columns(own, null_keys)
    pairs = left.join(right, keys, "full_outer").withColumns(
        {n: _or_none(F.col(n)) for n in ("n_src", "n_tgt")}
    )
    both = (F.col("n_src") > 0) & (F.col("n_tgt") > 0)
    nothing = F.array().cast("array<string>")
    pairs = pairs.withColumn("changed", F.when(both, changed_columns(pairs, own)).otherwise(nothing))
    state = (
        F.when(F.col("n_tgt") == 0, "source_only").when(F.col("n_src") == 0, "target_only")
        .when(F.size("changed") > 0, "mismatch").otherwise("equal")
    )
    pairs = slim(pairs.withColumn("state", state))
    counters = {
        "source_row_count": F.sum("n_src"),
        "target_row_count": F.sum("n_tgt"),
        "source_duplicates": F.count_if(F.col("n_src") > 1),
        "target_duplicates": F.count_if(F.col("n_tgt") > 1),
        "extra_records_in_source_count": F.count_if(F.col("n_tgt") == 0),
        "extra_records_in_target_count": F.count_if(F.col("n_src") == 0),
        "matched_key_count": F.count_if(both),
        "mismatch_record_count": F.count_if(F.size("changed") > 0),
        "mismatch_field_count": F.sum(F.size("changed").cast("bigint")),
    }
    for side, row in (("source", "src"), ("target", "tgt")):
        counters |= {f"{side}:{i}": F.sum(F.col(f"{row}_unfit")[i]) for i in range(len(typed[side]))}
    counters = {n: _or_none(c) for n, c in counters.items()}
    path = f"{base.rstrip('/')}/comparison"

    def write(watched: DataFrame, path: str, fmt: str, *, mode: str) -> None:
        save(watched.drop("src_unfit", "tgt_unfit"), path, fmt, mode=mode)

    n = save_observed(pairs, path, counters, write=write)
    spark = source.sparkSession
    run.classified = spark.read.schema(pairs.drop("src_unfit", "tgt_unfit").schema).parquet(path)
    unfit = {side: [n[f"{side}:{i}"] for i in range(len(columns))] for side, columns in typed.items()}
    for side, found in unfit.items():
        setattr(run, f"{side}_cast_failures", _failures(spark, run, side, dict(zip(typed[side], found, strict=True))))
    locations = {}
    if details:
        frames = run.details()
        locations = {name: save(df, f"{base.rstrip('/')}/{name}") for name, df in frames.items() if name != "schema_datatype_drift"}
    drifted = drift.drift_check(run.schema_drift.withColumn("pair", F.lit(""))).first()
    parts = C.physical_partitions(source, target)
    failed = {side: sum(f > 0 for f in found) for side, found in unfit.items()}
    row = {
        "source_count": n["source_row_count"],
        "target_count": n["target_row_count"],
        "row_count_status": _status(n["source_row_count"] != n["target_row_count"]),
        **parts,
        "partition_count_status": "INFO",
        "schema_drift_status": drifted.status,
        "schema_total_columns_checked": drifted.total_columns_checked,
        "schema_drift_columns": drifted.total_drift_columns,
        "failed_declared_type_cast_columns": drifted.failed_declared_type_cast_columns,
    }
    for side, found in unfit.items():
        row[f"{side}_cast_failure_status"] = _status(sum(found) > 0)
        row[f"{side}_failed_columns"] = failed[side]
        row[f"{side}_total_cast_failures"] = sum(found)
    extra = n["extra_records_in_source_count"], n["extra_records_in_target_count"]
    row |= {
        "source_duplicate_keys": n["source_duplicates"],
        "target_duplicate_keys": n["target_duplicates"],
        "extra_records_in_source": extra[0],
        "extra_records_in_target": extra[1],
        "matched_key_count": n["matched_key_count"],
        "mismatch_record_count": n["mismatch_record_count"],
        "mismatch_field_count": n["mismatch_field_count"],
    }
    states = [v for k, v in row.items() if k.endswith("_status")]
    bad = any((n["source_duplicates"], n["target_duplicates"], *extra, n["mismatch_record_count"]))
    row["overall_status"] = _status(bad or "FAIL" in states)
    row["run_timestamp"] = f"{stamp:%Y-%m-%d %H:%M:%S}"
    row["run_seconds"] = round(time.monotonic() - started, 3)
    row |= {f"{name}_location": where for name, where in locations.items()}
    kinds = {str: "string", int: "bigint", float: "double"}
    schema = ", ".join(f"{name} {kinds[type(v)]}" for name, v in row.items())
    return SavedValidation(
        summary=small_frame(spark, [tuple(row.values())], schema),
        checks=run.checks,
        compared=run.classified,
        mapping=own,
        locations=locations | {"comparison": path},
    )


def _status(failed: bool) -> str:
    return "FAIL" if failed else "PASS"


def _failures(spark, run: Validation, side: str, found: dict) -> DataFrame:
    """The cast failure report from counts that are known already."""
    rows = []
    for c in run.mapping.columns:
        missing = c.on(side) in run.missing[side]
        count = found.get(c, 0)
        rows.append((side, run.mapping.name(c), c.data_type, count, "SKIPPED" if missing else _status(count > 0)))
    return small_frame(
        spark, rows, "dataset_name string, column_name string, declared_data_type string, cast_failure_count bigint, status string"
    )
