"""Reports over a history of runs.

``run_history`` has one row per run: pipeline, stage (validation, reconciliation or revalidation),
run_id, run_ts and the columns of that stage's summary; columns of other stages are NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.lenient import lenient_int

STAGES = ["validation", "reconciliation", "revalidation"]

# Prices of a run, which ``run_cost`` takes as defaults.
PRICE_PER_HOUR = 0.44
ORCHESTRATION_FEE = 8 * 0.000025
NOTIFICATION_FEE = 0.0000005

# Summary columns the closing reports read, with their types.
SUMMARY_COLUMNS = {
    "source_format": "string",
    "target_format": "string",
    "source_count": "bigint",
    "target_count": "bigint",
    "total_mismatch": "bigint",
    "extra_records_in_source": "bigint",
    "extra_records_in_target": "bigint",
    "source_duplicate_keys": "bigint",
    "target_duplicate_keys": "bigint",
    "row_count_status": "string",
    "schema_drift_status": "string",
    "initial_target_count": "bigint",
    "final_target_count": "bigint",
    "total_updates": "bigint",
    "total_column_updates": "bigint",
    "total_inserts": "bigint",
    "total_deletes": "bigint",
    "net_change": "bigint",
    "overall_status": "string",
}


def history_row(manifest: DataFrame) -> DataFrame:
    """A manifest row in the one schema all stages share, ready to be appended to the history."""
    if "mismatch_record_count" in manifest.columns:
        manifest = manifest.withColumn("total_mismatch", F.col("mismatch_record_count"))
    have = set(manifest.columns)
    columns = [
        (F.col(c) if c in have else F.lit(None)).cast(t).alias(c) for c, t in SUMMARY_COLUMNS.items()
    ]
    return manifest.select("pipeline", "stage", "run_id", "run_ts", *columns)


def latest_run(history: DataFrame) -> DataFrame:
    """The newest run of every pipeline and stage; of equal times, the greater run id."""
    order = ["run_ts", "run_id"]
    rest = [c for c in history.columns if c not in ("pipeline", "stage", *order)]
    newest = history.groupBy("pipeline", "stage").agg(F.max(F.struct(*order, *rest)).alias("r"))
    return newest.select("pipeline", "stage", "r.*").select(*history.columns)


def latest_stages(history: DataFrame) -> DataFrame:
    """One row per pipeline with the newest run of each stage as a struct column."""
    rest = [c for c in history.columns if c not in ("pipeline", "stage", "run_ts", "run_id")]
    run = F.struct("run_ts", "run_id", *rest)
    return history.groupBy("pipeline").agg(
        *[F.max(F.when(F.col("stage") == s, run)).alias(s) for s in STAGES]
    )


def _or(value: Column, default) -> Column:
    return F.coalesce(value, F.lit(default))


def _remaining(count: Column, what: str) -> Column:
    left = F.concat(count.cast("string"), F.lit(f" {what}"))
    return F.when(count == 0, F.lit("None")).otherwise(left)


def _shown(*parts) -> Column:
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])


def closure_business(stages: DataFrame) -> DataFrame:
    """Four rows per pipeline: what was wrong, what was done, what is left."""
    val, rec, rev = F.col("validation"), F.col("reconciliation"), F.col("revalidation")
    gap_before = lenient_int(val["source_count"]) - lenient_int(val["target_count"])
    gap_after = lenient_int(rev["source_count"]) - lenient_int(rev["target_count"])
    bad_before, bad_after = lenient_int(val["total_mismatch"]), lenient_int(rev["total_mismatch"])
    drift_before = _or(val["schema_drift_status"], "UNKNOWN")
    drift_after = _or(rev["schema_drift_status"], "UNKNOWN")
    extra_before = lenient_int(val["extra_records_in_target"])
    extra_after = lenient_int(rev["extra_records_in_target"])

    def row(check: str, before: Column, action: Column, after: Column, left: Column) -> Column:
        return F.struct(
            F.lit(check).alias("check_type"),
            before.alias("before"),
            action.alias("action_taken"),
            after.alias("after"),
            left.alias("remaining_exception"),
        )

    rows = F.array(
        row(
            "Row count",
            _shown("Δ ", gap_before),
            _shown("Inserted ", lenient_int(rec["total_inserts"]), " missing rows"),
            _shown("Δ ", gap_after),
            F.when(gap_after == 0, F.lit("None")).otherwise(_shown("Δ ", gap_after)),
        ),
        row(
            "Value mismatch",
            _shown(bad_before, " mismatches"),
            _shown(lenient_int(rec["total_updates"]), " rows updated"),
            _shown(bad_after, " mismatches"),
            _remaining(bad_after, "mismatches remain"),
        ),
        row(
            "Schema drift",
            drift_before,
            F.when(F.upper(drift_before) == "PASS", "N/A").otherwise("Schema aligned"),
            drift_after,
            F.when(F.upper(drift_after) == "PASS", "None").otherwise("Drift remains"),
        ),
        row(
            "Deletion in target",
            extra_before.cast("string"),
            _shown(extra_before - extra_after, " rows deleted"),
            extra_after.cast("string"),
            _remaining(extra_after, "extra records remain"),
        ),
    )
    return stages.select("pipeline", F.inline(rows))


def closure_executive(stages: DataFrame) -> DataFrame:
    val, rec, rev = F.col("validation"), F.col("reconciliation"), F.col("revalidation")

    def time(stage: Column) -> Column:
        return _or(F.date_format(stage["run_ts"], "yyyy-MM-dd HH:mm:ss"), "")

    return stages.select(
        "pipeline",
        time(val).alias("validation_run_timestamp"),
        time(rec).alias("reconciliation_run_timestamp"),
        time(rev).alias("revalidation_run_timestamp"),
        _or(val["source_format"], "").alias("source_format"),
        _or(val["target_format"], "").alias("target_format"),
        _or(val["overall_status"], "").alias("validation_status"),
        _or(rec["overall_status"], "PASS").alias("reconciliation_status"),
        _or(rev["overall_status"], "").alias("revalidation_status"),
    )


def closure_comparative(stages: DataFrame) -> DataFrame:
    """Three rows per pipeline, one per stage."""

    def row(stage: str, s: Column) -> Column:
        checked = stage != "reconciliation"
        first, second = (
            ("source_count", "target_count")
            if checked
            else ("initial_target_count", "final_target_count")
        )

        def number(name: str) -> Column:
            return lenient_int(s[name]) if checked else F.lit(0).cast("bigint")

        def status(name: str) -> Column:
            return _or(s[name], "") if checked else F.lit("PASS")

        duplicates = (
            _shown(lenient_int(s["source_duplicate_keys"]), "/", lenient_int(s["target_duplicate_keys"]))
            if checked
            else F.lit("0/0")
        )
        return F.struct(
            F.lit(stage.capitalize()).alias("stage"),
            lenient_int(s[first]).alias("source_record_count"),
            lenient_int(s[second]).alias("target_record_count"),
            number("total_mismatch").alias("total_mismatches"),
            number("extra_records_in_source").alias("missing_records_in_target"),
            number("extra_records_in_target").alias("extra_records_in_target"),
            status("row_count_status").alias("row_count_status"),
            status("schema_drift_status").alias("schema_drift_status"),
            duplicates.alias("duplicate_keys"),
            _or(s["overall_status"], "" if checked else "PASS").alias("overall_status"),
        )

    return stages.select(
        "pipeline", F.inline(F.array(*[row(s, F.col(s)) for s in STAGES]))
    )


def closure_issues(stages: DataFrame) -> DataFrame:
    rev = F.col("revalidation")
    bad, extra = lenient_int(rev["total_mismatch"]), lenient_int(rev["extra_records_in_target"])
    drift = F.upper(_or(rev["schema_drift_status"], "UNKNOWN"))
    return stages.select(
        "pipeline",
        F.when(bad == 0, "All mismatches addressed via updates/inserts")
        .otherwise(_shown(bad, " mismatches remain"))
        .alias("unresolved_mismatches"),
        F.when(drift == "PASS", "None detected")
        .otherwise("Schema drift remains")
        .alias("schema_drift"),
        _remaining(extra, "extra records remain").alias("extra_records_in_target"),
        F.lit("None reported").alias("failed_operations"),
    )


def run_cost(
    job_runs: DataFrame,
    *,
    price_per_hour: float = PRICE_PER_HOUR,
    orchestration_fee: float = ORCHESTRATION_FEE,
    notification_fee: float = NOTIFICATION_FEE,
) -> DataFrame:
    """Duration and cost per execution from job_runs (execution_id, dpu_seconds, started, ended)."""
    totals = job_runs.groupBy("execution_id").agg(
        F.min("started").alias("start_time"),
        F.max("ended").alias("end_time"),
        F.sum(lenient_int(F.col("dpu_seconds"))).alias("dpu_seconds"),
    )
    seconds = F.unix_timestamp("end_time") - F.unix_timestamp("start_time")
    compute = F.col("dpu_seconds").cast("double") / 3600.0 * price_per_hour
    return totals.select(
        "execution_id",
        "start_time",
        "end_time",
        seconds.alias("duration_sec"),
        compute.alias("compute_cost"),
        F.lit(orchestration_fee).alias("orchestration_cost"),
        F.lit(notification_fee).alias("notification_cost"),
        (compute + F.lit(orchestration_fee) + F.lit(notification_fee)).alias("total_cost"),
    )


def run_manifest(
    summary: DataFrame, pipeline: str, stage: str, run_id: str, run_ts: Column | None = None
) -> DataFrame:
    """A stage summary as a row for the run history."""
    return summary.select(
        F.lit(pipeline).alias("pipeline"),
        F.lit(stage).alias("stage"),
        F.lit(run_id).alias("run_id"),
        (F.current_timestamp() if run_ts is None else run_ts).alias("run_ts"),
        "*",
    )
