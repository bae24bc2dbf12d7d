"""Queries that join several tables into one source by a configured plan."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans.prepare import JoinPlan, JoinStep, full_chain, join_tables, prepare
from .inputs import table

_SELECTED = {
    "inner": (
        JoinStep("orders", "customer", "o_custkey", "c_custkey", "inner"),
        ["orders.o_orderkey", "orders.o_custkey", "customer.c_name"],
        "select o_orderkey, o_custkey, c_name from orders join customer on o_custkey = c_custkey",
    ),
    "left": (
        JoinStep("orders", "lineitem", "o_orderkey", "l_orderkey", "left"),
        ["orders.o_orderkey", "lineitem.l_linenumber", "lineitem.l_quantity"],
        "select o_orderkey, l_linenumber, l_quantity from orders left join lineitem "
        "on o_orderkey = l_orderkey",
    ),
    "right": (
        JoinStep("orders", "customer", "o_custkey", "c_custkey", "right_outer"),
        ["customer.c_custkey", "orders.o_orderkey"],
        "select c_custkey, o_orderkey from orders right join customer on o_custkey = c_custkey",
    ),
    "full": (
        JoinStep("events", "customer", "user_id", "c_custkey", "full"),
        ["events.event_id", "events.user_id", "customer.c_custkey", "customer.c_name"],
        "select event_id, user_id, c_custkey, c_name from events full join customer "
        "on user_id = c_custkey",
    ),
    "semi": (
        JoinStep("customer", "orders", "c_custkey", "o_custkey", "left_semi"),
        ["customer.c_custkey", "customer.c_name"],
        "select c_custkey, c_name from customer semi join orders on c_custkey = o_custkey",
    ),
    "anti": (
        JoinStep("customer", "orders", "c_custkey", "o_custkey", "anti"),
        ["customer.c_custkey", "customer.c_name"],
        "select c_custkey, c_name from customer anti join orders on c_custkey = o_custkey",
    ),
}


def _join(step: JoinStep, columns: list[str]):
    def query(spark, sf_dir):
        tables = {t: table(spark, sf_dir, t) for t in (step.left, step.right)}
        joined = join_tables(tables, (step,))
        return joined.select(*[F.col(f"`{c}`").alias(c.split(".")[1]) for c in columns])

    return query


_CHAIN = (
    JoinStep("supplier", "customer", "s_suppkey", "c_custkey", "full"),
    JoinStep("result", "part", "s_suppkey", "p_partkey", "full"),
)


def prep_join_full_chain(spark, sf_dir):
    """Customers without a supplier of their number still find their part."""
    tables = {t: table(spark, sf_dir, t) for t in ("supplier", "customer", "part")}
    columns = ("supplier.s_suppkey", "customer.c_custkey", "part.p_partkey")
    joined = join_tables(tables, _CHAIN)
    return joined.select(*[F.col(f"`{c}`").alias(c.split(".")[1]) for c in columns])


def prep_full_chain_grouped(spark, sf_dir):
    """The chain from one grouping; customers of three nations share a number that has no supplier."""
    tables = {t: table(spark, sf_dir, t) for t in ("supplier", "customer", "part")}
    shared = F.when(F.col("c_nationkey") < 3, F.lit(-1)).otherwise(F.col("c_custkey"))
    tables["customer"] = tables["customer"].withColumn("c_custkey", shared)
    columns = ("supplier.s_suppkey", "supplier.s_name", "customer.c_custkey", "customer.c_name", "part.p_partkey", "part.p_name")
    joined = full_chain(tables, _CHAIN)
    return joined.select(*[F.col(f"`{c}`").alias(c.split(".")[1]) for c in columns])


PLAN = JoinPlan.from_json(
    {
        "multi_source_workflow": {
            "sources": [
                {"name": n, "type": "s3", "path": f"{n}.parquet"}
                for n in ("orders", "customer", "lineitem", "part")
            ],
            "join_steps": [
                {
                    "left": "orders",
                    "right": "customer",
                    "left_key": "o_custkey",
                    "right_key": "c_custkey",
                    "type": "inner",
                },
                {
                    "left": "result",
                    "right": "lineitem",
                    "left_key": "o_orderkey",
                    "right_key": "l_orderkey",
                    "type": "left",
                },
            ],
            "select_columns": [
                "orders.o_orderkey",
                "customer.c_custkey",
                "customer.c_name",
                "lineitem.l_linenumber",
                "lineitem.l_extendedprice",
            ],
            "column_mapping": {
                "orders.o_orderkey": "order_id",
                "customer.c_custkey": "customer_id",
                "customer.c_name": "customer_name",
                "lineitem.l_linenumber": "line",
                "lineitem.l_extendedprice": "amount",
            },
        }
    }
)


def _tables(spark, sf_dir):
    return {t: table(spark, sf_dir, t) for t in PLAN.tables}


def _target(spark, sf_dir):
    """A stored table with more columns than the plan asks for."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_suppkey").alias("customer_id"),
        F.col("l_returnflag").alias("customer_name"),
        F.col("l_linenumber").alias("line"),
        F.col("l_extendedprice").alias("amount"),
        "l_tax",
        "l_discount",
    )


def prep_project(spark, sf_dir):
    return prepare(PLAN, _tables(spark, sf_dir))[0]


def prep_target_project(spark, sf_dir):
    return prepare(PLAN, _tables(spark, sf_dir), _target(spark, sf_dir))[1]


def prep_full(spark, sf_dir):
    source, target = prepare(PLAN, _tables(spark, sf_dir), _target(spark, sf_dir))
    return source.withColumn("side", F.lit("source")).unionByName(
        target.withColumn("side", F.lit("target"))
    )


_SOURCE = (
    "select o_orderkey order_id, c_custkey customer_id, c_name customer_name, l_linenumber line, "
    "l_extendedprice amount from orders join customer on o_custkey = c_custkey "
    "left join lineitem on l_orderkey = o_orderkey"
)
_TARGET = (
    "select l_orderkey order_id, l_suppkey customer_id, l_returnflag customer_name, "
    "l_linenumber line, l_extendedprice amount from lineitem"
)

QUERIES = {
    **{f"prep_join_{n}": (_join(step, cols), sql) for n, (step, cols, sql) in _SELECTED.items()},
    "prep_join_full_chain": (
        prep_join_full_chain,
        "select s_suppkey, c_custkey, p_partkey from supplier full join customer on "
        "s_suppkey = c_custkey full join part on coalesce(s_suppkey, c_custkey) = p_partkey",
    ),
    "prep_full_chain_grouped": (
        prep_full_chain_grouped,
        "with c as (select * replace (case when c_nationkey < 3 then -1 else c_custkey end as c_custkey) from customer) "
        "select s_suppkey, s_name, c_custkey, c_name, p_partkey, p_name from supplier full join c on "
        "s_suppkey = c_custkey full join part on coalesce(s_suppkey, c_custkey) = p_partkey",
    ),
    "prep_project": (prep_project, _SOURCE),
    "prep_target_project": (prep_target_project, _TARGET),
    "prep_full": (
        prep_full,
        f"select *, 'source' side from ({_SOURCE}) a union all select *, 'target' from ({_TARGET}) b",
    ),
}
