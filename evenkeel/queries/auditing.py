"""Queries over foreign keys, rule tables and tables stored by key hash."""

from __future__ import annotations

from ..operators.integrity import (
    VALUE_RULES,
    ForeignKey,
    Rule,
    apply_rules,
    orphan_rows,
    orphan_values,
    referential_integrity,
)
from ..operators.repair import plan_repair
from ..plans.observed import save_repair, save_validation
from ..sources import partitioned as P
from ..sources.save import scratch
from .checking import QUERIES as _CHECKED
from .checking import _null_sql
from .comparing import QUERIES as _COMPARED
from .inputs import MAPPING, TARGET_COLUMNS, pair, run, table
from .repairing import _APPLIED, EXISTING, INCOMING, ROWS
from .repairing import QUERIES as _REPAIRED

# Children with some references that lead nowhere (a third of the lines to one part) and some that are NULL.
CHILDREN = {
    "orders": "select o_orderkey, case when o_orderkey % 61 = 0 then o_custkey + 5000000 when o_orderkey % 67 = 0 then null "
    "else o_custkey end o_custkey from orders",
    "lineitem": "select case when l_partkey % 83 = 0 then -l_orderkey - 1 else l_orderkey end l_orderkey, l_linenumber, "
    "case when l_suppkey % 3 = 0 then -1 else l_partkey end l_partkey, "
    "case when l_linenumber = 7 then null else l_suppkey end l_suppkey from lineitem",
    "customer": "select c_custkey, case when c_custkey % 41 = 0 then 99 else c_nationkey end c_nationkey from customer",
}
KEYS = [
    ForeignKey("order_customer", "orders", ("o_custkey",), "customer", ("c_custkey",)),
    ForeignKey("line_order", "lineitem", ("l_orderkey",), "orders", ("o_orderkey",)),
    ForeignKey("line_part", "lineitem", ("l_partkey",), "part", ("p_partkey",)),
    ForeignKey("line_supplier", "lineitem", ("l_suppkey",), "supplier", ("s_suppkey",)),
    ForeignKey("customer_nation", "customer", ("c_nationkey",), "nation", ("n_nationkey",)),
]


def _star(spark, sf_dir):
    whole = {t: table(spark, sf_dir, t) for t in ("part", "supplier", "nation")}
    return whole | {name: run(spark, sf_dir, sql) for name, sql in CHILDREN.items()}


def foreign_keys(spark, sf_dir):
    return referential_integrity(_star(spark, sf_dir), KEYS)


def foreign_key_orphans(spark, sf_dir):
    found = orphan_values(_star(spark, sf_dir), KEYS)
    return found.selectExpr("constraint_name", "array_join(value, ',') value", "orphan_rows")


def foreign_key_orphan_rows(spark, sf_dir):
    return orphan_rows(_star(spark, sf_dir), KEYS, "line_part")


RULES = [
    Rule("e1", "events", "event_id", "not_null"),
    Rule("e2", "events", "user_id", "min", low=0),
    Rule("e3", "events", "value", "range", low=0, high=400, tolerance=0.01),
    Rule("e4", "events", "value", "max", high=100, tolerance=0.5),
    Rule("e5", "events", "event_type", "in_set", allowed=("click", "view", "purchase")),
    Rule("e6", "events", "props", "pattern", pattern='[{]"k": [0-9][}]', tolerance=0.95),
    Rule("e7", "events", "event_type", "length", low=3, high=6, tolerance=0.1),
    Rule("e8", "events", None, "row_count", low=1),
    Rule("e9", "events", "value", "avg", low=0, high=20),
    Rule("e10", "events", "value", "sum", low=0),
    Rule("e11", "events", "event_type", "approx_distinct", low=2, high=5),
    Rule("e12", "events", "gone", "not_null"),
    Rule("o1", "orders", "o_orderkey", "not_null"),
    Rule("o2", "orders", "o_orderkey", "min", low=1),
    Rule("o3", "orders", "o_totalprice", "range", low=1000, high=400000, tolerance=0.3),
    Rule("o4", "orders", "o_orderpriority", "pattern", pattern="[1-5]-[A-Z]+( [A-Z]+)*"),
    Rule("o5", "orders", "o_orderstatus", "in_set", allowed=("F", "O")),
    Rule("o6", "orders", "o_totalprice", "maximum", high=1e6),
    Rule("o7", "orders", "o_totalprice", "minimum", low=0),
    Rule("o8", "orders", "o_orderdate", "min", low="1995-06-01 00:00:00", tolerance=0.01),
    Rule("x1", "returns", "r_key", "not_null"),
]


def rule_table(spark, sf_dir):
    return apply_rules({t: table(spark, sf_dir, t) for t in ("events", "orders")}, RULES)


def upsert_stored(spark, sf_dir):
    path = P.write_keyed(run(spark, sf_dir, EXISTING), f"{scratch(spark)}.parquet", ["order_no"], parts=32)
    P.upsert_stored(path, run(spark, sf_dir, INCOMING), ["order_no"], parts=32)
    return P.read_keyed(spark, path)


def repair_stored(spark, sf_dir):
    source, target = pair(spark, sf_dir)
    path = P.write_target(target, f"{scratch(spark)}.parquet", MAPPING, parts=32)
    P.repair_stored(path, source, MAPPING, parts=32)
    return P.read_keyed(spark, path)


def summary_observed(spark, sf_dir):
    """The summary of a stored comparison, without what depends on the run."""
    saved = save_validation(*pair(spark, sf_dir), MAPPING, scratch(spark), details=False)
    return saved.summary.drop(
        "source_partition_count", "target_partition_count", "partition_count_status", "run_timestamp", "run_seconds"
    )


def mismatch_observed(spark, sf_dir):
    """The long report read off the comparison that the counting pass stored."""
    saved = save_validation(*pair(spark, sf_dir), MAPPING, scratch(spark))
    return spark.read.parquet(saved.locations["detailed_mismatch"])


def _saved_repair(spark, sf_dir):
    source, target = pair(spark, sf_dir)
    return save_repair(plan_repair(target, source, MAPPING), f"{scratch(spark)}.parquet")


def repair_observed(spark, sf_dir):
    return _saved_repair(spark, sf_dir).summary


def null_counts_observed(spark, sf_dir):
    return _saved_repair(spark, sf_dir).null_counts


# --- SQL side -----------------------------------------------------------------------------------

_WITH = "with " + ", ".join(f"{n}_ as ({sql})" for n, sql in CHILDREN.items())


def _from(name: str) -> str:
    return f"{name}_" if name in CHILDREN else name


def _orphan(k: ForeignKey) -> str:
    child, parent = k.child_columns[0], k.parent_columns[0]
    return f"{child} is not null and {child} not in (select {parent} from {_from(k.parent)} where {parent} is not null)"


def _rule_sql(r: Rule) -> str:
    shown = f"'{r.rule_id}' rule_id, '{r.table}' table_name, {f"'{r.column}'" if r.column else "null"} column_name, '{r.kind}' rule_kind"
    if r.table not in ("events", "orders") or r.column == "gone":
        return f"select {shown}, null::bigint checked_rows, null::bigint failed_rows, null::double value, 'SKIPPED' status"
    low, high = (f"'{v}'" if isinstance(v, str) else v for v in (r.low, r.high))
    if r.kind in VALUE_RULES:
        value = f"length({r.column})" if r.kind == "length" else r.column
        tests = [f"{value} < {low}"] * (r.low is not None and r.kind != "max")
        tests += [f"{value} > {high}"] * (r.high is not None and r.kind != "min")
        broken = {
            "not_null": f"{r.column} is null",
            "pattern": f"not regexp_full_match({r.column}, '{r.pattern}')",
            "in_set": f"{r.column} not in ({', '.join(repr(v) for v in r.allowed or ())})",
        }.get(r.kind) or " or ".join(tests)
        count = f"count(*) filter (where {broken})"
        return (
            f"select {shown}, count(*) checked_rows, {count} failed_rows, null::double value, "
            f"case when {count} > {r.tolerance} * count(*) then 'FAIL' else 'PASS' end status from {r.table}"
        )
    total = f"sum({r.column}::decimal(38,6))::double"
    number = {
        "row_count": "count(*)", "sum": total, "avg": f"{total} / count({r.column})", "minimum": f"min({r.column})",
        "maximum": f"max({r.column})", "approx_distinct": f"count(distinct {r.column})",
    }[r.kind]
    tests = [f"{number} < {low}"] * (r.low is not None) + [f"{number} > {high}"] * (r.high is not None)
    return (
        f"select {shown}, count(*) checked_rows, null::bigint failed_rows, ({number})::double value, "
        f"case when {' or '.join(tests)} then 'FAIL' else 'PASS' end status from {r.table}"
    )


QUERIES = {
    "foreign_keys": (
        foreign_keys,
        f"{_WITH} " + " union all ".join(
            f"select '{k.name}' constraint_name, '{k.child}' child_table, '{k.parent}' parent_table, "
            f"count({k.child_columns[0]}) checked_rows, count(*) - count({k.child_columns[0]}) null_rows, "
            f"count(distinct case when {_orphan(k)} then {k.child_columns[0]} end) orphan_values, "
            f"count(*) filter (where {_orphan(k)}) orphan_rows, "
            f"case when count(*) filter (where {_orphan(k)}) > 0 then 'FAIL' else 'PASS' end status from {_from(k.child)}"
            for k in KEYS
        ),
    ),
    "foreign_key_orphans": (
        foreign_key_orphans,
        f"{_WITH} " + " union all ".join(
            f"select '{k.name}' constraint_name, {k.child_columns[0]}::varchar as value, count(*) orphan_rows "
            f"from {_from(k.child)} where {_orphan(k)} group by {k.child_columns[0]}"
            for k in KEYS
        ),
    ),
    "foreign_key_orphan_rows": (foreign_key_orphan_rows, f"{_WITH} select * from lineitem_ where {_orphan(KEYS[2])}"),
    "rule_table": (rule_table, " union all ".join(map(_rule_sql, RULES))),
    "upsert_stored": (upsert_stored, _REPAIRED["upsert_by_key"][1]),
    "summary_observed": (summary_observed, _CHECKED["validation_summary"][1]),
    "mismatch_observed": (mismatch_observed, _COMPARED["mismatch_long"][1]),
    "repair_observed": (repair_observed, _REPAIRED["recon_summary"][1]),
    "null_counts_observed": (null_counts_observed, _null_sql(TARGET_COLUMNS, f"({ROWS} {_APPLIED}) x")),
    "repair_stored": (repair_stored, _REPAIRED["recon_apply"][1]),
}
