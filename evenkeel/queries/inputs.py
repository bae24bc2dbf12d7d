"""Inputs of the registered queries: the given tables, and a source/target pair made from them.

The SQL texts here run unchanged in Spark and in the engine the results are checked with.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..mapping import ColumnMap, Mapping

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def run(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run a SQL text over the given tables without registering views."""
    used = [t for t in TABLES if re.search(rf"\b(from|join) {t}\b", sql)]
    named = re.sub(r"\b(from|join) (" + "|".join(used) + r")\b", r"\1 {\2}", sql)
    return spark.sql(named, **{t: table(spark, sf_dir, t) for t in used})


_PRICE = "cast(cast(o_totalprice as decimal(18,2)) as string)"
_DATE = "cast(cast(o_orderdate as date) as string)"
_KEY = "cast(o_orderkey as string)"
_CUST = "cast(o_custkey as string)"
_EXTRA = "cast(o_orderkey + 1000000 as string)"

# All columns are text, as after a raw read; the last branch adds exact copies.
SOURCE = f"""
select {_KEY} order_id, {_CUST} customer_id, o_orderstatus status,
       {_PRICE} price, {_DATE} order_date, o_orderpriority priority
from orders
union all
select {_KEY}, {_CUST}, o_orderstatus, {_PRICE}, {_DATE}, o_orderpriority
from orders where o_orderkey % 211 = 0
"""

# The target spells some keys 1.0, pads some texts, differs in some prices and priorities, holds
# some prices that are no numbers, lacks some rows and has extra rows, some of them twice.
TARGET = f"""
select case when o_orderkey % 3 = 0 then concat({_KEY}, '.0') else {_KEY} end ord_id,
       {_CUST} cust_id,
       case when o_orderkey % 60 = 0 then concat('  ', o_orderstatus, '  ')
            else o_orderstatus end status_cd,
       case when o_orderkey % 50 = 0
                 then cast(cast(o_totalprice as decimal(18,2)) + 10 as string)
            when o_orderkey % 307 = 0 then 'n/a'
            else {_PRICE} end price_amt,
       {_DATE} order_dt,
       case when o_orderkey % 75 = 0 then '' when o_orderkey % 80 = 0 then null
            else o_orderpriority end prio
from orders where o_orderkey % 97 <> 0
union all
select {_EXTRA}, {_CUST}, o_orderstatus, {_PRICE}, {_DATE}, o_orderpriority
from orders where o_orderkey % 101 = 0
union all
select {_EXTRA}, {_CUST}, o_orderstatus, {_PRICE}, {_DATE}, o_orderpriority
from orders where o_orderkey % 505 = 0
"""

MAPPING = Mapping.of(
    ["order_id"],
    [
        ColumnMap("order_id", "ord_id", "numeric"),
        ColumnMap("customer_id", "cust_id", "integer"),
        ColumnMap("status", "status_cd", "string"),
        ColumnMap("price", "price_amt", "numeric"),
        ColumnMap("order_date", "order_dt", "date"),
        ColumnMap("priority", "prio", "string"),
    ],
)

LINES = Mapping.of(
    ["l_orderkey", "l_linenumber"],
    [
        ColumnMap("l_orderkey", "l_orderkey", "integer"),
        ColumnMap("l_linenumber", "l_linenumber", "integer"),
        ColumnMap("l_partkey", "l_partkey", "integer"),
        ColumnMap("l_suppkey", "l_suppkey", "integer"),
        ColumnMap("l_quantity", "l_quantity", "double"),
        ColumnMap("l_extendedprice", "l_extendedprice", "double"),
        ColumnMap("l_discount", "l_discount", "double"),
        ColumnMap("l_tax", "l_tax", "double"),
        ColumnMap("l_returnflag", "l_returnflag", "string"),
        ColumnMap("l_linestatus", "l_linestatus", "string"),
        ColumnMap("l_shipdate", "l_shipdate", "timestamp"),
    ],
)


def pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return run(spark, sf_dir, SOURCE), run(spark, sf_dir, TARGET)


# --- SQL side -----------------------------------------------------------------------------------

SOURCE_COLUMNS = [c.source for c in MAPPING.columns]
TARGET_COLUMNS = [c.target for c in MAPPING.columns]


def sql_typed(value: str, kind: str) -> str:
    x = f"trim({value})"
    if kind == "numeric":
        return f"try_cast({x} as decimal(38,10))"
    if kind == "integer":
        return (
            f"case when regexp_full_match({x}, '[+-]?[0-9]+([.][0-9]*)?') "
            f"then try_cast(regexp_extract({x}, '^[+-]?[0-9]+') as bigint) end"
        )
    if kind == "date":
        return f"try_cast({x} as date)"
    return x


def sql_norm(value: str, kind: str) -> str:
    return f"coalesce(cast({sql_typed(value, kind)} as varchar), '')"


def _least(table_name: str, columns: list[str]) -> str:
    order = ", ".join(f"{c} nulls first" for c in columns)
    return (
        f"select * exclude (rn) from (select *, count(*) over (partition by k) n, "
        f"row_number() over (partition by k order by {order}) rn from {table_name}) where rn = 1"
    )


def sql_differs(c: ColumnMap, source: str = "", target: str = "") -> str:
    return (
        f"{sql_norm(source + c.source, c.kind)} <> {sql_norm(target + c.target, c.kind)}"
    )


_FLAGS = ", ".join(
    f"n_src > 0 and n_tgt > 0 and {sql_differs(c)} as d_{c.source}" for c in MAPPING.compare
)

#: WITH clause: src, tgt, sk, tk (with normalized key k), s, t (one row per key), c (classified).
PAIR = f"""
with src as ({SOURCE}), tgt as ({TARGET}),
sk as (select *, {sql_norm('order_id', 'numeric')} k from src),
tk as (select *, {sql_norm('ord_id', 'numeric')} k from tgt),
s as ({_least('sk', SOURCE_COLUMNS)}),
t as ({_least('tk', TARGET_COLUMNS)}),
p as (select coalesce(s.k, t.k) k, coalesce(s.n, 0) n_src, coalesce(t.n, 0) n_tgt,
             s.* exclude (k, n), t.* exclude (k, n) from s full join t on s.k = t.k),
c as (select *, {_FLAGS} from p)
"""

#: The names of the differing columns of a classified row, as comma text.
CHANGED = "concat_ws(',', " + ", ".join(
    f"case when d_{c.source} then '{c.source}' end" for c in MAPPING.compare
) + ")"
