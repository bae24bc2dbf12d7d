"""The chain as jobs on stored tables; runs are linked by a stored run history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..mapping import Mapping
from ..operators import history as H
from ..operators import repair
from ..sources.load import detect_format, load
from ..sources.save import save, save_bundle, save_reconciled, settle
from .validation import Validation


def record(row: DataFrame, history: str) -> None:
    """Append a run to the history."""
    save(H.history_row(row), history, mode="append", single=True)


def read_history(spark: SparkSession, history: str) -> DataFrame:
    return load(spark, history)


def validate_job(
    spark: SparkSession,
    source: str,
    target: str,
    mapping: Mapping,
    *,
    out: str,
    history: str,
    pipeline: str,
    run_id: str,
    stage: str = "validation",
    **options,
) -> str:
    """Validate two stored tables, write checks and details below ``out``, return the status."""
    run = Validation(load(spark, source), load(spark, target), mapping, settled=True, **options)
    with run:
        base = f"{out.rstrip('/')}/run_id={run_id}"
        save_bundle({"checks": run.checks, **run.details()}, base)
        summary = run.summary.select(
            F.lit(detect_format(source)).alias("source_format"),
            F.lit(detect_format(target)).alias("target_format"),
            "*",
        )
        save(summary, f"{base}/summary", single=True)
        row = load(spark, f"{base}/summary", fmt="parquet")
        record(H.run_manifest(row, pipeline, stage, run_id), history)
    return row.first().overall_status


def reconcile_job(
    spark: SparkSession,
    source: str,
    target: str,
    mapping: Mapping,
    *,
    out: str,
    history: str,
    pipeline: str,
    run_id: str,
    null_update: str = "keep",
    null_keys: str = "equal",
) -> str:
    """Repair a stored target into a new location in its own format and return that location."""
    fmt = detect_format(target)
    fmt = fmt if fmt in ("csv", "json", "parquet") else "parquet"
    plan = settle(
        repair.plan_repair(
            load(spark, target),
            load(spark, source),
            mapping,
            null_update=null_update,
            null_keys=null_keys,
        )
    )
    base = f"{out.rstrip('/')}/run_id={run_id}"
    path = save_reconciled(repair.repaired(plan), f"{base}/target.{fmt}", fmt, mapping)
    save_bundle(
        {
            f"{action}_details": repair.repair_details(plan, mapping, action)
            for action in ("update", "insert", "delete")
        },
        base,
    )
    save(repair.repair_summary(plan), f"{base}/summary", single=True)
    row = load(spark, f"{base}/summary", fmt="parquet")
    record(H.run_manifest(row, pipeline, "reconciliation", run_id), history)
    return path


def closure_job(spark: SparkSession, history: str, out: str) -> dict[str, str]:
    """Write the closing reports over the newest run of every stage of every pipeline."""
    stages = settle(H.latest_stages(read_history(spark, history)))
    return save_bundle(
        {
            "business_summary": H.closure_business(stages),
            "executive_summary": H.closure_executive(stages),
            "comparative_summary": H.closure_comparative(stages),
            "issues": H.closure_issues(stages),
        },
        out,
    )
