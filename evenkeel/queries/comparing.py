"""Queries that compare the pair by key and by value."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import compare
from ..operators.checks import mismatch_by_column
from ..operators.classify import classify, paired
from .inputs import (
    CHANGED,
    LINES,
    MAPPING,
    PAIR,
    SOURCE,
    SOURCE_COLUMNS,
    TARGET,
    TARGET_COLUMNS,
    pair,
    run,
    sql_norm,
    table,
)


def _presence(read):
    def query(spark, sf_dir):
        return read(compare.key_presence(*pair(spark, sf_dir), MAPPING), MAPPING)

    return query


def _compared(read):
    def query(spark, sf_dir):
        return read(paired(*pair(spark, sf_dir), MAPPING), MAPPING)

    return query


def _lines(read, **options):
    return lambda spark, sf_dir: read(table(spark, sf_dir, "lineitem"), LINES, "source", **options)


def distinct_keys(spark, sf_dir):
    return compare.distinct_keys(run(spark, sf_dir, SOURCE), MAPPING, "source")


def classify_rows(spark, sf_dir):
    found = classify(*pair(spark, sf_dir), MAPPING)
    return found.select(
        F.col("_k0").alias("key"), "n_src", "n_tgt", "state", F.array_join("changed", ",").alias("changed")
    )


def classify_null_keys(spark, sf_dir):
    """Keys that are NULL on some rows of both sides; they must meet no other row."""
    source = run(spark, sf_dir, _NULL_SOURCE)
    target = run(spark, sf_dir, _NULL_TARGET)
    found = classify(source, target, MAPPING, null_keys="distinct")
    return found.groupBy("state").agg(
        F.count(F.lit(1)).alias("keys"),
        F.sum("n_src").alias("source_rows"),
        F.sum("n_tgt").alias("target_rows"),
    )


_NULL_SOURCE = (
    "select case when status = 'P' then null else order_id end order_id, customer_id, status, "
    f"price, order_date, priority from ({SOURCE}) x"
)
_NULL_TARGET = (
    "select case when trim(status_cd) = 'P' then null else ord_id end ord_id, cust_id, status_cd, "
    f"price_amt, order_dt, prio from ({TARGET}) x"
)


def mismatch_columns(spark, sf_dir):
    return mismatch_by_column(classify(*pair(spark, sf_dir), MAPPING))


def mismatch_target_names(spark, sf_dir):
    """The long report under the target's column names."""
    named = MAPPING.__class__(MAPPING.keys, MAPPING.compare, MAPPING.gaps, "target")
    return compare.mismatch_long(paired(*pair(spark, sf_dir), named), named)


def detail_head(spark, sf_dir):
    found = compare.mismatch_long(paired(*pair(spark, sf_dir), MAPPING), MAPPING)
    return compare.detail_head(found, ["order_id", "column_name"], 5)


_ANY = " or ".join(f"d_{c.source}" for c in MAPPING.compare)
_LONG = " union all ".join(
    f"select order_id, '{c.source}' column_name, {c.source} source_value, {c.target} target_value "
    f"from c where d_{c.source}"
    for c in MAPPING.compare
)
_LONG_TARGET = " union all ".join(
    f"select order_id ord_id, '{c.target}' column_name, {c.source} source_value, "
    f"{c.target} target_value from c where d_{c.source}"
    for c in MAPPING.compare
)
_WIDE = ", ".join(
    f"{c.source} source_{c.source}, {c.target} target_{c.source}" for c in MAPPING.compare
)


def _hash(columns: list[str]) -> str:
    norms = ", ".join(sql_norm(x, c.kind) for x, c in zip(columns[1:], MAPPING.compare))
    return f"sha256(concat_ws('||', {norms}))"


_HASHES = (
    f"select order_id, {_hash(SOURCE_COLUMNS)} source_row_hash, "
    f"{_hash(TARGET_COLUMNS)} target_row_hash from c where n_src > 0 and n_tgt > 0"
)
_LINE_COLUMNS = ", ".join(c.source for c in LINES.columns)
_NULL_SIDES = f"""
s2 as (select {sql_norm('order_id', 'numeric')} k,
                  case when order_id is null then 's' else '' end side from ({_NULL_SOURCE}) a),
t2 as (select {sql_norm('ord_id', 'numeric')} k,
             case when ord_id is null then 't' else '' end side from ({_NULL_TARGET}) b),
b as (select k, side, sum(a) n_src, sum(b) n_tgt
      from (select k, side, 1 a, 0 b from s2 union all select k, side, 0, 1 from t2) group by k, side)
"""
# Differences are those of the plain pair, for keys that are not NULL on either side.
_NULL_STATES = f"""
select state, count(*) as keys, cast(sum(n_src) as bigint) source_rows,
       cast(sum(n_tgt) as bigint) target_rows
from (select case when n_tgt = 0 then 'source_only' when n_src = 0 then 'target_only'
                  when k in (select k from c where n_src > 0 and n_tgt > 0 and ({_ANY}))
                  then 'mismatch' else 'equal' end state, n_src, n_tgt from b)
group by state
"""

QUERIES = {
    "extra_in_source": (
        _presence(compare.extra_in_source),
        f"{PAIR} select order_id from c where n_tgt = 0",
    ),
    "extra_in_target": (
        _presence(compare.extra_in_target),
        f"{PAIR} select ord_id order_id from c where n_src = 0",
    ),
    "matched_keys": (
        _presence(compare.matched_keys),
        f"{PAIR} select k order_id from c where n_src > 0 and n_tgt > 0",
    ),
    "distinct_keys": (distinct_keys, f"{PAIR} select distinct k order_id from sk"),
    "duplicate_keys": (
        _lines(compare.duplicate_keys),
        "select l_orderkey, l_linenumber, count(*) as count from lineitem group by all having count(*) > 1",
    ),
    "duplicate_rows": (
        _lines(compare.duplicate_rows),
        f"select {_LINE_COLUMNS}, n duplicate_count from (select *, count(*) over "
        "(partition by l_orderkey, l_linenumber) n from lineitem) where n > 1",
    ),
    "dedupe_by_key": (
        _lines(compare.dedupe_by_key),
        f"select {_LINE_COLUMNS} from (select *, row_number() over (partition by l_orderkey, "
        f"l_linenumber order by {_LINE_COLUMNS}) rn from lineitem) where rn = 1",
    ),
    "classify_rows": (
        classify_rows,
        f"{PAIR} select k as key, n_src, n_tgt, case when n_tgt = 0 then 'source_only' "
        f"when n_src = 0 then 'target_only' when {_ANY} then 'mismatch' else 'equal' end state, "
        f"{CHANGED} changed from c",
    ),
    "classify_null_keys": (
        classify_null_keys,
        f"{PAIR}, {_NULL_SIDES} {_NULL_STATES}",
    ),
    "mismatch_long": (_compared(compare.mismatch_long), f"{PAIR} {_LONG}"),
    "mismatch_wide": (
        _compared(compare.mismatch_wide),
        f"{PAIR} select order_id, {_WIDE}, {CHANGED} mismatched_columns from c where {_ANY}",
    ),
    "mismatch_target_names": (mismatch_target_names, f"{PAIR} {_LONG_TARGET}"),
    "hash_mismatch_rows": (
        _compared(compare.hash_mismatch_rows),
        f"{PAIR} select * from ({_HASHES}) where source_row_hash <> target_row_hash",
    ),
    "mismatch_by_column": (
        mismatch_columns,
        f"{PAIR} select column_name, count(*) update_count from ({_LONG}) group by column_name",
    ),
    "detail_head": (
        detail_head,
        f"{PAIR} select * from ({_LONG}) order by order_id, column_name limit 5",
    ),
}
