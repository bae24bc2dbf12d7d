"""Queries over a run history in which every order is a run of its customer's pipeline."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import history as H
from ..plans.validation import Validation
from .checking import COUNTED, _SUMMARY
from .inputs import MAPPING, pair, run

HISTORY = """
select concat('pipeline_', cast(o_custkey as string)) pipeline,
       case o_orderkey % 3 when 0 then 'validation' when 1 then 'reconciliation'
            else 'revalidation' end stage,
       o_orderkey run_id, o_orderdate run_ts,
       case when o_orderkey % 3 <> 1 then concat(cast(q as string), '.0') end source_count,
       case when o_orderkey % 3 <> 1 then cast(q + r - 1 as string) end target_count,
       case when o_orderkey % 3 <> 1 then case when r = 2 then 'n/a' else cast(r as string) end end
       total_mismatch,
       case when o_orderkey % 3 <> 1 then n - 1 end extra_records_in_source,
       case when o_orderkey % 3 <> 1 then r end extra_records_in_target,
       case when o_orderkey % 3 <> 1 then n end source_duplicate_keys,
       case when o_orderkey % 3 <> 1 then r end target_duplicate_keys,
       case when o_orderkey % 3 <> 1 then case when r = 0 then 'PASS' else 'FAIL' end end
       row_count_status,
       case when o_orderkey % 5 = 0 then null when o_orderstatus = 'F' then 'FAIL'
            when o_orderkey % 3 <> 1 then 'pass' end schema_drift_status,
       case when o_orderkey % 3 <> 1 then case when o_orderstatus = 'O' then 'csv' else 'json' end end
       source_format,
       case when o_orderkey % 3 <> 1 then 'parquet' end target_format,
       case when o_orderkey % 3 = 1 then q end initial_target_count,
       case when o_orderkey % 3 = 1 then q + n end final_target_count,
       case when o_orderkey % 3 = 1 then n end total_inserts,
       case when o_orderkey % 3 = 1 then r end total_updates,
       case when o_orderkey % 3 = 1 then null when r > 0 then 'FAIL' else 'PASS' end overall_status
from orders join (
    select l_orderkey, cast(sum(cast(l_quantity as bigint)) as bigint) q, count(*) n,
           cast(sum(case when l_returnflag = 'R' then 1 else 0 end) as bigint) r
    from lineitem group by l_orderkey) x on l_orderkey = o_orderkey
"""
JOB_RUNS = """
select concat('execution_', cast(o_custkey as string)) execution_id,
       case when l_linenumber = 2 then concat(cast(l_quantity as bigint), '.9')
            when l_linenumber = 3 then '' else cast(cast(l_quantity as bigint) as string) end dpu_seconds,
       o_orderdate started, l_shipdate ended
from orders join lineitem on l_orderkey = o_orderkey
"""


def latest_run(spark, sf_dir):
    newest = H.latest_run(run(spark, sf_dir, HISTORY))
    shown = F.date_format("run_ts", "yyyy-MM-dd HH:mm:ss")
    return newest.select("pipeline", "stage", "run_id", shown.alias("run_ts"), "overall_status")


def _closure(report):
    return lambda spark, sf_dir: report(H.latest_stages(run(spark, sf_dir, HISTORY)))


def run_cost(spark, sf_dir):
    cost = H.run_cost(run(spark, sf_dir, JOB_RUNS))
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    amount = lambda c: F.round(c, 9).alias(c)
    return cost.select(
        "execution_id",
        stamp("start_time"),
        stamp("end_time"),
        "duration_sec",
        amount("compute_cost"),
        amount("orchestration_cost"),
        amount("notification_cost"),
        amount("total_cost"),
    )


def run_manifest(spark, sf_dir):
    """The summary of the pair's validation as a history row."""
    summary = Validation(*pair(spark, sf_dir), MAPPING).summary
    row = H.run_manifest(summary, "orders", "validation", "run_1", F.lit("2024-01-01 00:00:00"))
    return row


# --- SQL side -----------------------------------------------------------------------------------

_LATEST = f"""
with h as ({HISTORY}),
l as (select * from (select *, row_number() over (partition by pipeline, stage
      order by run_ts desc, run_id desc) rn from h) where rn = 1)
"""


def _int(value: str) -> str:
    return f"coalesce(cast(trunc(try_cast(trim(cast({value} as varchar)) as double)) as bigint), 0)"


_STAGES = f"""{_LATEST},
x as (select p.pipeline,
             {_int('v.source_count')} - {_int('v.target_count')} gap1,
             {_int('z.source_count')} - {_int('z.target_count')} gap2,
             {_int('v.total_mismatch')} bad1, {_int('z.total_mismatch')} bad2,
             coalesce(v.schema_drift_status, 'UNKNOWN') drift1,
             coalesce(z.schema_drift_status, 'UNKNOWN') drift2,
             {_int('v.extra_records_in_target')} extra1, {_int('z.extra_records_in_target')} extra2,
             {_int('r.total_inserts')} inserts, {_int('r.total_updates')} updates,
             v.run_ts t1, r.run_ts t2, z.run_ts t3, v.source_format sf, v.target_format tf,
             v.overall_status o1, r.overall_status o2, z.overall_status o3
      from (select distinct pipeline from h) p
      left join l v on v.pipeline = p.pipeline and v.stage = 'validation'
      left join l r on r.pipeline = p.pipeline and r.stage = 'reconciliation'
      left join l z on z.pipeline = p.pipeline and z.stage = 'revalidation')
"""
_BUSINESS = """
select pipeline, 'Row count' check_type, concat('Δ ', gap1) as before,
       concat('Inserted ', inserts, ' missing rows') action_taken, concat('Δ ', gap2) as after,
       case when gap2 = 0 then 'None' else concat('Δ ', gap2) end remaining_exception from x
union all
select pipeline, 'Value mismatch', concat(bad1, ' mismatches'), concat(updates, ' rows updated'),
       concat(bad2, ' mismatches'),
       case when bad2 = 0 then 'None' else concat(bad2, ' mismatches remain') end from x
union all
select pipeline, 'Schema drift', drift1,
       case when upper(drift1) = 'PASS' then 'N/A' else 'Schema aligned' end, drift2,
       case when upper(drift2) = 'PASS' then 'None' else 'Drift remains' end from x
union all
select pipeline, 'Deletion in target', cast(extra1 as varchar), concat(extra1 - extra2, ' rows deleted'),
       cast(extra2 as varchar),
       case when extra2 = 0 then 'None' else concat(extra2, ' extra records remain') end from x
"""


def _stage_row(stage: str) -> str:
    pipelines = (
        f"(select distinct pipeline from h) p left join l on l.pipeline = p.pipeline "
        f"and l.stage = '{stage}'"
    )
    if stage == "reconciliation":
        return (
            f"select p.pipeline, 'Reconciliation' stage, {_int('initial_target_count')} "
            f"source_record_count, {_int('final_target_count')} target_record_count, "
            "0 total_mismatches, 0 missing_records_in_target, 0 extra_records_in_target, "
            "'PASS' row_count_status, 'PASS' schema_drift_status, '0/0' duplicate_keys, "
            f"coalesce(overall_status, 'PASS') overall_status from {pipelines}"
        )
    return (
        f"select p.pipeline, '{stage.capitalize()}' stage, {_int('source_count')} source_record_count, "
        f"{_int('target_count')} target_record_count, {_int('total_mismatch')} total_mismatches, "
        f"{_int('extra_records_in_source')} missing_records_in_target, "
        f"{_int('extra_records_in_target')} extra_records_in_target, "
        "coalesce(row_count_status, '') row_count_status, "
        "coalesce(schema_drift_status, '') schema_drift_status, "
        f"concat({_int('source_duplicate_keys')}, '/', {_int('target_duplicate_keys')}) "
        f"duplicate_keys, coalesce(overall_status, '') overall_status from {pipelines}"
    )


def _time(column: str) -> str:
    return f"coalesce(strftime({column}, '%Y-%m-%d %H:%M:%S'), '')"


_EXECUTIVE = (
    f"select pipeline, {_time('t1')} validation_run_timestamp, "
    f"{_time('t2')} reconciliation_run_timestamp, {_time('t3')} revalidation_run_timestamp, "
    "coalesce(sf, '') source_format, coalesce(tf, '') target_format, "
    "coalesce(o1, '') validation_status, coalesce(o2, 'PASS') reconciliation_status, "
    "coalesce(o3, '') revalidation_status from x"
)
_ISSUES = (
    "select pipeline, case when bad2 = 0 then 'All mismatches addressed via updates/inserts' "
    "else concat(bad2, ' mismatches remain') end unresolved_mismatches, "
    "case when upper(drift2) = 'PASS' then 'None detected' else 'Schema drift remains' end "
    "schema_drift, case when extra2 = 0 then 'None' else concat(extra2, ' extra records remain') "
    "end extra_records_in_target, 'None reported' failed_operations from x"
)
_COMPUTE = "cast(s as double) / cast(3600.0 as double) * cast(0.44 as double)"
_COST = (
    f"with j as ({JOB_RUNS}), t as (select execution_id, min(started) a, max(ended) b, "
    f"sum({_int('dpu_seconds')}) s from j group by 1) select execution_id, "
    "strftime(a, '%Y-%m-%d %H:%M:%S') start_time, strftime(b, '%Y-%m-%d %H:%M:%S') end_time, "
    "cast(date_diff('second', a, b) as bigint) duration_sec, "
    f"round({_COMPUTE}, 9) compute_cost, cast(0.0002 as double) orchestration_cost, "
    "round(cast(0.0000005 as double), 9) notification_cost, "
    f"round({_COMPUTE} + cast(0.0002 as double) + cast(0.0000005 as double), 9) total_cost from t"
)

QUERIES = {
    "latest_run": (
        latest_run,
        f"{_LATEST} select pipeline, stage, run_id, strftime(run_ts, '%Y-%m-%d %H:%M:%S') run_ts, "
        "overall_status from l",
    ),
    "closure_business": (_closure(H.closure_business), f"{_STAGES} {_BUSINESS}"),
    "closure_comparative": (
        _closure(H.closure_comparative),
        f"{_LATEST} " + " union all ".join(_stage_row(s) for s in H.STAGES),
    ),
    "closure_executive": (_closure(H.closure_executive), f"{_STAGES} {_EXECUTIVE}"),
    "closure_issues": (_closure(H.closure_issues), f"{_STAGES} {_ISSUES}"),
    "run_cost": (run_cost, _COST),
    "run_manifest": (
        run_manifest,
        f"{COUNTED} select 'orders' pipeline, 'validation' stage, 'run_1' run_id, "
        f"'2024-01-01 00:00:00' run_ts, v.* from ({_SUMMARY}) v",
    ),
}
