"""Queries on schema drift and layout. The column catalog describes one table pair per order."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import drift as D
from ..operators import layout
from .inputs import MAPPING, SOURCE, TARGET, run, table

_PAIR = "concat('pair_', cast(l_orderkey as string))"
_NAME = "concat('col_', cast(l_linenumber as string))"

CATALOG = f"""
select {_PAIR} pair, case when l_suppkey % 2 = 0 then 'source' else 'target' end side,
       {_NAME} column_name, l_linenumber ordinal,
       case when l_quantity > 30 then 'string'
            else case l_partkey % 8 when 0 then 'bigint' when 1 then 'int' when 2 then 'double'
                 when 3 then 'decimal(38,10)' when 4 then 'boolean' when 5 then 'date'
                 when 6 then 'timestamp' else 'timestamp_ntz' end end data_type
from lineitem
"""
DECLARED = f"""
select {_PAIR} pair, {_NAME} column_name,
       min(case cast(l_tax * 100 as int) when 0 then 'numeric' when 1 then 'integer'
           when 2 then 'double' when 3 then 'boolean' when 4 then 'date' when 5 then 'timestamp'
           else 'string' end) declared_data_type
from lineitem group by 1, 2
"""


def _types(spark, sf_dir):
    return D.column_types(run(spark, sf_dir, DECLARED), run(spark, sf_dir, CATALOG))


def _drift(rule):
    return lambda spark, sf_dir: rule(_types(spark, sf_dir))


def schema_drift_check(spark, sf_dir):
    return D.drift_check(D.drift_family(_types(spark, sf_dir)))


def missing_columns(spark, sf_dir):
    required = run(spark, sf_dir, DECLARED).select(
        "pair", F.explode(F.array(F.lit("source"), F.lit("target"))).alias("side"), "column_name"
    )
    return layout.missing_columns(required, run(spark, sf_dir, CATALOG))


def rename_target_to_common(spark, sf_dir):
    return layout.rename_to_common(run(spark, sf_dir, TARGET), MAPPING, "target")


def rename_source_to_common(spark, sf_dir):
    named = MAPPING.__class__(MAPPING.keys, MAPPING.compare, MAPPING.gaps, "target")
    return layout.rename_to_common(run(spark, sf_dir, SOURCE), named, "source")


def align_target_layout(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    target = orders.select(
        "o_orderpriority", "o_orderkey", F.upper("o_orderstatus").alias("extra_status")
    )
    source = orders.select("o_orderkey", "o_custkey", "o_orderpriority")
    return layout.align_target_layout(target, source)


_STORED = (
    "select cast(o_orderkey as string) order_no, case when o_orderkey % 9 = 0 then 'x' else "
    "cast(o_custkey as string) end cust, cast(cast(o_orderdate as date) as string) order_day, "
    "o_orderstatus status from orders"
)
_WANTED = T.StructType(
    [
        T.StructField("order_no", T.LongType()),
        T.StructField("cust", T.DecimalType(12, 2)),
        T.StructField("order_day", T.DateType()),
        T.StructField("clerk", T.StringType()),
    ]
)


def _as_text(df):
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def cast_to_schema(spark, sf_dir):
    return _as_text(layout.cast_to_schema(run(spark, sf_dir, _STORED), _WANTED))


def project_to_schema(spark, sf_dir):
    found, absent = layout.project_to_schema(run(spark, sf_dir, _STORED), _WANTED)
    return _as_text(found).withColumn("absent_columns", F.lit(",".join(absent)))


def flatten_nested(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.struct(
            F.col("l_linenumber").alias("number"),
            F.struct(F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supplier")).alias(
                "item"
            ),
        ).alias("line"),
        F.array("l_partkey", "l_suppkey").alias("keys"),
        F.create_map(F.lit("flag"), "l_returnflag").alias("marks"),
    )
    return layout.flatten_nested(lines)


def union_by_name(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_suppkey").alias("key")
    )
    return customers.unionByName(suppliers)


# --- SQL side -----------------------------------------------------------------------------------

_TYPES = f"""
with d as ({DECLARED}), cat as ({CATALOG}),
c as (select pair, column_name, min(case when side = 'source' then data_type end) s,
             min(case when side = 'target' then data_type end) t from cat group by 1, 2),
y as (select d.*, s, t from d left join c on d.pair = c.pair and d.column_name = c.column_name)
"""


def _rows(case: str, warn: str = "''") -> str:
    return (
        f"{_TYPES}, z as (select pair, column_name, declared_data_type, s is not null source_exists, "
        "t is not null target_exists, s source_data_type, t target_data_type, "
        f"{case} drift_type from y), w as (select *, case when drift_type = 'NO_DRIFT' then 'PASS' "
        f"when drift_type = {warn} then 'WARN' else 'FAIL' end status from z)"
    )


def _family(column: str) -> str:
    return (
        f"case when {column} like 'decimal%' then 'decimal' when {column} in ('bigint', 'int') then "
        f"'integer' when {column} = 'double' then 'floating' when {column} like 'timestamp%' then "
        f"'timestamp' else {column} end"
    )


def _fits(column: str) -> str:
    return (
        "case declared_data_type "
        f"when 'numeric' then {_family(column)} in ('integer', 'floating', 'decimal') "
        f"when 'string' then {_family(column)} = 'string' "
        f"when 'boolean' then {_family(column)} = 'boolean' "
        f"when 'date' then {_family(column)} in ('date', 'timestamp', 'string') "
        f"when 'timestamp' then {_family(column)} in ('timestamp', 'string') else true end"
    )


_EXPECTED = (
    "case declared_data_type when 'numeric' then 'decimal(38,10)' when 'integer' then 'bigint' "
    "else declared_data_type end"
)
_EXACT = (
    "case when s is null then 'MISSING_IN_SOURCE' when t is null then 'MISSING_IN_TARGET' "
    "when s <> t then 'DATA_TYPE_MISMATCH' else 'NO_DRIFT' end"
)
_FAMILY = (
    "case when s is null then 'MISSING_IN_SOURCE' when t is null then 'MISSING_IN_TARGET' "
    f"when not ({_fits('s')} and {_fits('t')}) then 'DECLARED_TYPE_INCOMPATIBLE' "
    "when s = t then 'NO_DRIFT' else 'COMPATIBLE_TYPE_VARIATION' end"
)
_TYPED = (
    "case when s is null then 'MISSING_TYPED_COLUMN_IN_SOURCE' "
    "when t is null then 'MISSING_TYPED_COLUMN_IN_TARGET' "
    f"when s <> {_EXPECTED} or t <> {_EXPECTED} then 'DECLARED_TYPE_CAST_MISMATCH' "
    "else 'NO_DRIFT' end"
)
_WARN = "'COMPATIBLE_TYPE_VARIATION'"
_RENAMED = ", ".join(f"{c.target} {c.source}" for c in MAPPING.columns)
_RENAMED_SOURCE = ", ".join(f"{c.source} {c.target}" for c in MAPPING.columns)

QUERIES = {
    "schema_drift_exact": (_drift(D.drift_exact), f"{_rows(_EXACT)} select * from w"),
    "schema_drift_family": (_drift(D.drift_family), f"{_rows(_FAMILY, _WARN)} select * from w"),
    "schema_drift_typed": (_drift(D.drift_typed), f"{_rows(_TYPED)} select * from w"),
    "schema_drift_check": (
        schema_drift_check,
        f"{_rows(_FAMILY, _WARN)} select *, case when total_drift_columns > 0 then 'FAIL' else "
        "'PASS' end status from (select pair, count(*) total_columns_checked, "
        "count(*) filter (where status = 'FAIL') total_drift_columns, "
        "count(*) filter (where status = 'WARN') total_warn_columns, "
        "0 datatype_mismatch_count, "
        "count(*) filter (where status = 'WARN') compatible_type_variation_count, "
        "count(*) filter (where drift_type = 'DECLARED_TYPE_INCOMPATIBLE') "
        "declared_type_incompatible_count, 0 failed_declared_type_cast_columns, "
        "count(*) filter (where not source_exists) missing_columns_in_source, "
        "count(*) filter (where source_exists and not target_exists) missing_columns_in_target "
        "from w group by pair)",
    ),
    "missing_columns": (
        missing_columns,
        f"with d as ({DECLARED}), cat as ({CATALOG}), r as (select pair, side, column_name from d "
        "cross join (values ('source'), ('target')) v(side)) select r.* from r anti join cat "
        "on r.pair = cat.pair and r.side = cat.side and r.column_name = cat.column_name",
    ),
    "rename_target_to_common": (
        rename_target_to_common,
        f"select {_RENAMED} from ({TARGET}) x",
    ),
    "rename_source_to_common": (
        rename_source_to_common,
        f"select {_RENAMED_SOURCE} from ({SOURCE}) x",
    ),
    "align_target_layout": (
        align_target_layout,
        "select o_orderkey, cast(null as bigint) o_custkey, o_orderpriority, "
        "upper(o_orderstatus) extra_status from orders",
    ),
    "cast_to_schema": (
        cast_to_schema,
        "select cast(try_cast(order_no as bigint) as varchar) order_no, "
        "cast(try_cast(cust as decimal(12,2)) as varchar) cust, "
        "cast(try_cast(order_day as date) as varchar) order_day, status "
        f"from ({_STORED}) x",
    ),
    "project_to_schema": (
        project_to_schema,
        "select cast(try_cast(order_no as bigint) as varchar) order_no, "
        "cast(try_cast(cust as decimal(12,2)) as varchar) cust, "
        "cast(try_cast(order_day as date) as varchar) order_day, 'clerk' absent_columns "
        f"from ({_STORED}) x",
    ),
    "flatten_nested": (
        flatten_nested,
        "select l_orderkey, l_linenumber line_number, l_partkey line_item_part, "
        "l_suppkey line_item_supplier, concat('[', l_partkey, ',', l_suppkey, ']') keys, "
        "concat('{\"flag\":\"', l_returnflag, '\"}') marks from lineitem",
    ),
    "union_by_name": (
        union_by_name,
        "select c_custkey as key, c_name as name from customer "
        "union all select s_suppkey, s_name from supplier",
    ),
}
