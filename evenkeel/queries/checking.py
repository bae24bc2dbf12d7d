"""Queries that count: the single checks and the whole validation run."""

from __future__ import annotations

from ..operators import checks as C
from ..operators.compare import key_presence
from ..operators.classify import classify
from ..plans.validation import Validation
from .inputs import (
    MAPPING,
    PAIR,
    SOURCE,
    SOURCE_COLUMNS,
    TARGET,
    TARGET_COLUMNS,
    pair,
    run,
    sql_typed,
    table,
)


def row_count_check(spark, sf_dir):
    return C.row_count_check(*pair(spark, sf_dir))


def partition_count_check(spark, sf_dir):
    return C.partition_count_check(*pair(spark, sf_dir), "status", "status_cd")


def partition_count_dates(spark, sf_dir):
    return C.partition_count_check(*pair(spark, sf_dir), "order_date", "order_dt")


def duplicate_key_check(spark, sf_dir):
    totals = C.key_totals(key_presence(*pair(spark, sf_dir), MAPPING))
    return C.duplicate_key_check(totals, "source").unionByName(
        C.duplicate_key_check(totals, "target")
    )


def missing_extra_check(spark, sf_dir):
    return C.missing_extra_check(C.key_totals(key_presence(*pair(spark, sf_dir), MAPPING)))


def mismatch_check(spark, sf_dir):
    return C.mismatch_check(C.key_totals(classify(*pair(spark, sf_dir), MAPPING)))


def _failures(spark, sf_dir):
    source, target = pair(spark, sf_dir)
    return C.cast_failures(source, MAPPING, "source"), C.cast_failures(target, MAPPING, "target")


def cast_failures(spark, sf_dir):
    source, target = _failures(spark, sf_dir)
    return source.unionByName(target)


def cast_failure_check(spark, sf_dir):
    source, target = _failures(spark, sf_dir)
    return C.cast_failure_check(source, "source").unionByName(C.cast_failure_check(target, "target"))


def validation_checks(spark, sf_dir):
    return Validation(*pair(spark, sf_dir), MAPPING).checks


def overall_status(spark, sf_dir):
    return Validation(*pair(spark, sf_dir), MAPPING).overall_status


def validation_summary(spark, sf_dir):
    return Validation(*pair(spark, sf_dir), MAPPING).summary


def null_counts(spark, sf_dir):
    return C.null_counts(run(spark, sf_dir, TARGET))


def null_counts_labels(spark, sf_dir):
    """NULLs that a left join leaves behind in a wide table."""
    documents = table(spark, sf_dir, "documents")
    return C.null_counts(documents.join(table(spark, sf_dir, "labels"), "doc_id", "left"))


def check_sql(name: str, counters: dict[str, str], failed: str, source: str) -> str:
    """Check rows: each counter's SQL value, all with one status."""
    rows = " union all ".join(
        f"select '{name}' validation_name, '{counter}' counter, cast({value} as bigint) as value, "
        f"case when {failed} then 'FAIL' else 'PASS' end status from {source}"
        for counter, value in counters.items()
    )
    return rows


_COUNTS = """
n as (select sum(n_src) srows, sum(n_tgt) trows, sum(cast(n_src > 1 as int)) sdup,
             sum(cast(n_tgt > 1 as int)) tdup, sum(cast(n_tgt = 0 as int)) sonly,
             sum(cast(n_src = 0 as int)) tonly, sum(cast(n_src > 0 and n_tgt > 0 as int)) matched,
             sum(cast({any} as int)) bad, sum({fields}) fields from c)
""".format(
    any=" or ".join(f"d_{c.source}" for c in MAPPING.compare),
    fields=" + ".join(f"cast(d_{c.source} as int)" for c in MAPPING.compare),
)
COUNTED = f"{PAIR}, {_COUNTS}"

ROW_COUNT = check_sql(
    "row_count_validation",
    {"source_row_count": "srows", "target_row_count": "trows"},
    "srows <> trows",
    "n",
)
DUPLICATES = (
    check_sql("source_duplicate_key_validation", {"duplicate_key_count": "sdup"}, "sdup > 0", "n")
    + " union all "
    + check_sql("target_duplicate_key_validation", {"duplicate_key_count": "tdup"}, "tdup > 0", "n")
)
MISSING = check_sql(
    "missing_extra_by_key_validation",
    {
        "extra_records_in_source_count": "sonly",
        "extra_records_in_target_count": "tonly",
        "matched_key_count": "matched",
    },
    "sonly > 0 or tonly > 0",
    "n",
)
MISMATCH = check_sql(
    "hash_mismatch_validation",
    {"mismatch_record_count": "bad", "mismatch_field_count": "fields"},
    "bad > 0",
    "n",
)


def _failure_sql(side: str, columns: list[str]) -> str:
    rows = []
    for c, column in zip(MAPPING.columns, columns):
        fails = f"trim({column}) <> '' and {sql_typed(column, c.kind)} is null"
        rows.append(
            f"select '{side}' dataset_name, '{c.source}' column_name, "
            f"'{c.data_type}' declared_data_type, count(*) filter (where {fails}) cast_failure_count "
            f"from {'src' if side == 'source' else 'tgt'}"
        )
    return " union all ".join(rows)


FAILURES = (
    f"select *, case when cast_failure_count > 0 then 'FAIL' else 'PASS' end status from "
    f"({_failure_sql('source', SOURCE_COLUMNS)} union all {_failure_sql('target', TARGET_COLUMNS)})"
)


def _failure_check(side: str) -> str:
    totals = (
        "(select count(*) filter (where cast_failure_count > 0) failed, "
        f"sum(cast_failure_count) total from ({FAILURES}) where dataset_name = '{side}')"
    )
    return check_sql(
        f"{side}_cast_failure_validation",
        {"failed_columns": "failed", "total_cast_failures": "total"},
        "total > 0",
        totals,
    )


FAILURE_CHECKS = f"{_failure_check('source')} union all {_failure_check('target')}"
# The typed columns of the pair have the declared types by construction.
_DRIFT = " union all ".join(
    f"select 'schema_datatype_drift_validation' validation_name, '{counter}' counter, "
    f"cast({value} as bigint) as value, 'PASS' status"
    for counter, value in {
        "total_columns_checked": len(MAPPING.columns),
        "total_drift_columns": 0,
        "failed_declared_type_cast_columns": 0,
    }.items()
)
CHECKS = " union all ".join([ROW_COUNT, DUPLICATES, MISSING, MISMATCH, FAILURE_CHECKS, _DRIFT])

_SUMMARY = """
select srows source_count, trows target_count,
       case when srows = trows then 'PASS' else 'FAIL' end row_count_status,
       'PASS' schema_drift_status, 6 schema_total_columns_checked, 0 schema_drift_columns,
       0 failed_declared_type_cast_columns,
       {failures},
       sdup source_duplicate_keys, tdup target_duplicate_keys, sonly extra_records_in_source,
       tonly extra_records_in_target, matched matched_key_count, bad mismatch_record_count,
       fields mismatch_field_count,
       (select case when max(cast(status = 'FAIL' as int)) = 1 then 'FAIL' else 'PASS' end
        from ({checks}) x) overall_status
from n
""".format(
    checks=CHECKS,
    failures=", ".join(
        f"(select max(status) from ({_failure_check(side)}) x) {side}_cast_failure_status, "
        f"(select max(value) from ({_failure_check(side)}) x where counter = 'failed_columns') "
        f"{side}_failed_columns, (select max(value) from ({_failure_check(side)}) x "
        f"where counter = 'total_cast_failures') {side}_total_cast_failures"
        for side in ("source", "target")
    ),
)


def _partition_sql(source: str, target: str) -> str:
    return (
        f"with src as ({SOURCE}), tgt as ({TARGET}), "
        f"a as (select coalesce(trim({source}), '') p, count(*) n from src group by 1), "
        f"b as (select coalesce(trim({target}), '') p, count(*) n from tgt group by 1) "
        "select coalesce(a.p, b.p) as partition, coalesce(a.n, 0) source_row_count, "
        "coalesce(b.n, 0) target_row_count, case when coalesce(a.n, 0) <> coalesce(b.n, 0) "
        "then 'FAIL' else 'PASS' end status from a full join b on a.p = b.p"
    )


def _null_sql(columns: list[str], source: str) -> str:
    return " union all ".join(
        f"select '{c}' column_name, count(*) filter (where {c} is null) null_count from {source}"
        for c in columns
    )


QUERIES = {
    "row_count_check": (row_count_check, f"{COUNTED} {ROW_COUNT}"),
    "partition_count_check": (partition_count_check, _partition_sql("status", "status_cd")),
    "partition_count_dates": (partition_count_dates, _partition_sql("order_date", "order_dt")),
    "duplicate_key_check": (duplicate_key_check, f"{COUNTED} {DUPLICATES}"),
    "missing_extra_check": (missing_extra_check, f"{COUNTED} {MISSING}"),
    "mismatch_check": (mismatch_check, f"{COUNTED} {MISMATCH}"),
    "cast_failures": (cast_failures, f"{PAIR} {FAILURES}"),
    "cast_failure_check": (cast_failure_check, f"{PAIR} {FAILURE_CHECKS}"),
    "validation_checks": (validation_checks, f"{COUNTED} {CHECKS}"),
    "overall_status": (
        overall_status,
        f"{COUNTED} select case when max(cast(status = 'FAIL' as int)) = 1 then 'FAIL' "
        f"else 'PASS' end overall_status from ({CHECKS})",
    ),
    "validation_summary": (validation_summary, f"{COUNTED} {_SUMMARY}"),
    "null_counts": (null_counts, _null_sql(TARGET_COLUMNS, f"({TARGET}) x")),
    "null_counts_labels": (
        null_counts_labels,
        _null_sql(
            ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"],
            "(select d.doc_id, text, lang, source, n_chars, quality, toxic from documents d "
            "left join labels l on d.doc_id = l.doc_id) x",
        ),
    ),
}
