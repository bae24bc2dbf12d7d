"""Queries that repair the target of the pair."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import repair
from ..plans.validation import Validation
from ..sources.save import settle
from .checking import CHECKS, _COUNTS
from .inputs import (
    MAPPING, PAIR, SOURCE, SOURCE_COLUMNS, TARGET, TARGET_COLUMNS, pair, run, sql_differs, sql_norm,
)


def recon_update(spark, sf_dir):
    source, target = pair(spark, sf_dir)
    return repair.update_rows(target, source, MAPPING)


def recon_update_union(spark, sf_dir):
    source, target = pair(spark, sf_dir)
    return repair.update_rows(target, source, MAPPING, scope="union", null_update="overwrite")


def recon_insert(spark, sf_dir):
    source, target = pair(spark, sf_dir)
    return repair.insert_rows(target, source, MAPPING)


def recon_delete(spark, sf_dir):
    source, target = pair(spark, sf_dir)
    return repair.delete_rows(target, source, MAPPING)


def _plan(spark, sf_dir):
    source, target = pair(spark, sf_dir)
    return repair.plan_repair(target, source, MAPPING)


def recon_apply(spark, sf_dir):
    return repair.repaired(_plan(spark, sf_dir))


def recon_apply_null_keys(spark, sf_dir):
    """Rows without an order number are no partners, though both sides have some."""
    source, target = pair(spark, sf_dir)
    none = F.lit(None).cast("string")
    source = source.withColumn("order_id", F.when(F.col("status") == "P", none).otherwise(F.col("order_id")))
    target = target.withColumn("ord_id", F.when(F.col("status_cd") == "P", none).otherwise(F.col("ord_id")))
    plan = repair.plan_repair(target, source, MAPPING, null_update="overwrite", null_keys="distinct")
    return repair.repaired(plan)


def recon_summary(spark, sf_dir):
    return repair.repair_summary(_plan(spark, sf_dir))


def _details(action):
    return lambda spark, sf_dir: repair.repair_details(_plan(spark, sf_dir), MAPPING, action)


def revalidation_checks(spark, sf_dir):
    source, _ = pair(spark, sf_dir)
    return Validation(source, settle(recon_apply(spark, sf_dir)), MAPPING).checks


# New prices for some orders, several for some of them, and some orders the table does not have.
INCOMING = """
select o_orderkey + case when l_linenumber > 5 then 1000000 else 0 end order_no,
       cast(cast(l_extendedprice as decimal(18,2)) as string) price, l_returnflag flag
from orders join lineitem on l_orderkey = o_orderkey
"""
EXISTING = """
select o_orderkey order_no, cast(cast(o_totalprice as decimal(18,2)) as string) price,
       o_orderstatus flag
from orders
"""


def upsert_by_key(spark, sf_dir):
    return repair.upsert_by_key(
        run(spark, sf_dir, EXISTING), run(spark, sf_dir, INCOMING), ["order_no"]
    )


# --- SQL side: every target row against the one source row of its key ------------------------------

_S = ", ".join(f"s.{c} s_{c}" for c in SOURCE_COLUMNS)
_T = ", ".join(f"tk.{c} t_{c}" for c in TARGET_COLUMNS)
_FLAGS = ", ".join(
    f"s_k is not null and t_k is not null and {sql_differs(c, 's_', 't_')} as d_{c.source}"
    for c in MAPPING.compare
)
_ANY = " or ".join(f"d_{c.source}" for c in MAPPING.compare)
ROWS = f"""{PAIR},
j as (select s.k s_k, tk.k t_k, {_S}, {_T} from s full join tk on s.k = tk.k),
r as (select *, {_FLAGS} from j)
"""
_CHANGED = "concat_ws(',', " + ", ".join(
    f"case when d_{c.source} then '{c.source}' end" for c in MAPPING.compare
) + ")"
_OLD = ", ".join(f"t_{c} {c}" for c in TARGET_COLUMNS)
_NEW = ", ".join(f"s_{c.source} {c.target}" for c in MAPPING.columns)
_FIXED = "t_ord_id ord_id, " + ", ".join(
    f"case when d_{c.source} then coalesce(s_{c.source}, t_{c.target}) else t_{c.target} end {c.target}"
    for c in MAPPING.compare
)
# The columns that differ somewhere are overwritten in every changed row.
_UNION = "t_ord_id ord_id, " + ", ".join(
    f"case when ({_ANY}) and (select bool_or(d_{c.source}) from r) then s_{c.source} "
    f"else t_{c.target} end {c.target}"
    for c in MAPPING.compare
)
_INSERTS = f"select {_NEW} from r where t_k is null"
_APPLIED = (
    f"select {_FIXED} from r where s_k is not null and t_k is not null union all {_INSERTS}"
)
# The same rows with keys that are NULL on both sides and meet no other side.
_NULL_ROWS = ROWS
for _was, _is in {
    f"src as ({SOURCE})": f"src as (select case when status = 'P' then null else order_id end order_id, * exclude (order_id) from ({SOURCE}))",
    f"tgt as ({TARGET})": f"tgt as (select case when status_cd = 'P' then null else ord_id end ord_id, * exclude (ord_id) from ({TARGET}))",
    f"{sql_norm('order_id', 'numeric')} k": f"case when order_id is null then 's' else {sql_norm('order_id', 'numeric')} end k",
    f"{sql_norm('ord_id', 'numeric')} k": f"case when ord_id is null then 't' else {sql_norm('ord_id', 'numeric')} end k",
}.items():
    if _NULL_ROWS.count(_was) != 1:
        raise ValueError(f"no such part: {_was}")
    _NULL_ROWS = _NULL_ROWS.replace(_was, _is)
_OVERWRITTEN = "t_ord_id ord_id, " + ", ".join(
    f"case when d_{c.source} then s_{c.source} else t_{c.target} end {c.target}" for c in MAPPING.compare
)
# The pair's WITH clause with the repaired rows in place of the target.
_AGAIN = (
    f"with fixed as ({ROWS} {_APPLIED}), "
    + PAIR.strip().removeprefix("with ").replace(
        PAIR[PAIR.index("tgt as (") : PAIR.index("sk as (")], "tgt as (select * from fixed),\n"
    )
    + f", {_COUNTS}"
)

QUERIES = {
    "recon_update": (recon_update, f"{ROWS} select {_FIXED} from r where t_k is not null"),
    "recon_update_union": (
        recon_update_union,
        f"{ROWS} select {_UNION} from r where t_k is not null",
    ),
    "recon_insert": (
        recon_insert,
        f"{ROWS} select {_OLD} from r where t_k is not null union all {_INSERTS}",
    ),
    "recon_delete": (
        recon_delete,
        f"{ROWS} select {_OLD} from r where t_k is not null and s_k is not null",
    ),
    "recon_apply": (recon_apply, f"{ROWS} {_APPLIED}"),
    "recon_summary": (
        recon_summary,
        f"{ROWS} select count(t_k) initial_target_count, count(s_k) final_target_count, "
        f"count(*) filter (where {_ANY}) total_updates, "
        "cast(sum(" + " + ".join(f"cast(d_{c.source} as int)" for c in MAPPING.compare) + ") as bigint) "
        "total_column_updates, count(*) filter (where t_k is null) total_inserts, "
        "count(*) filter (where s_k is null) total_deletes, count(s_k) - count(t_k) net_change from r",
    ),
    "recon_apply_null_keys": (
        recon_apply_null_keys,
        f"{_NULL_ROWS} select {_OVERWRITTEN} from r where s_k is not null and t_k is not null union all {_INSERTS}",
    ),
    "recon_update_details": (
        _details("update"),
        f"{ROWS} select t_ord_id order_id, {_CHANGED} updated_columns from r where {_ANY}",
    ),
    "recon_insert_details": (
        _details("insert"),
        f"{ROWS} select s_order_id order_id from r where t_k is null",
    ),
    "recon_delete_details": (
        _details("delete"),
        f"{ROWS} select t_ord_id order_id from r where s_k is null",
    ),
    "revalidation_checks": (revalidation_checks, f"{_AGAIN} {CHECKS}"),
    "upsert_by_key": (
        upsert_by_key,
        f"with old as ({EXISTING}), inc as ({INCOMING}), new as (select order_no, price, flag from "
        "(select *, row_number() over (partition by order_no order by price, flag) rn from inc) "
        "where rn = 1) select * from old where order_no not in (select order_no from new) "
        "union all select * from new",
    ),
}
