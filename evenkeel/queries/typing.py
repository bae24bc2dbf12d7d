"""Queries on typing, normalization, hashing and the scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import typed as ty
from ..functions.lenient import split_list
from ..functions.normalize import norm_numeric, norm_text, row_hash
from ..functions.typed import is_blank
from ..operators.layout import dates_as_text, with_norm, with_typed
from .inputs import MAPPING, TARGET, run, sql_norm, sql_typed, table

_C = F.col

# Raw texts, each made from a given table.
RAW = {
    "numeric": f"select ord_id id, price_amt raw from ({TARGET}) x",
    "string": f"select ord_id id, status_cd raw from ({TARGET}) x",
    "whole": "select cast(l_orderkey as string) id, concat(case when l_linenumber = 2 then '-' "
    "when l_linenumber = 3 then ' ' else '' end, cast(cast(l_extendedprice as decimal(18,2)) "
    "as string), case when l_linenumber = 4 then 'x' else '' end) raw from lineitem",
    "boolean": "select cast(o_orderkey as string) id, case o_orderkey % 7 when 0 then 'true' "
    "when 1 then 'F' when 2 then ' yes ' when 3 then '0' when 4 then 'maybe' when 5 then '' "
    "end raw from orders",
    "date": "select cast(o_orderkey as string) id, case when o_orderkey % 11 = 0 then 'n/a' "
    "when o_orderkey % 13 = 0 then concat(' ', cast(cast(o_orderdate as date) as string), ' ') "
    "when o_orderkey % 17 = 0 then '1999-02-30' "
    "else cast(cast(o_orderdate as date) as string) end raw from orders",
    "timestamp": "select cast(event_id as string) id, case when event_id % 11 = 0 then 'n/a' "
    "else concat(cast(cast(ts as date) as string), ' ', lpad(cast(hour(ts) as string), 2, '0'), "
    "':', lpad(cast(minute(ts) as string), 2, '0'), ':', lpad(cast(second(ts) as string), 2, '0')) "
    "end raw from events",
    "us_date": "select cast(o_orderkey as string) id, case when o_orderkey % 11 = 0 then "
    "'13/40/1999' else concat(cast(month(o_orderdate) as string), '/', "
    "cast(day(o_orderdate) as string), '/', cast(year(o_orderdate) as string)) end raw from orders",
    "us_time": "select cast(event_id as string) id, case when event_id % 11 = 0 then 'n/a' else "
    "concat(cast(month(ts) as string), '/', cast(day(ts) as string), '/', "
    "cast(year(ts) as string), ' ', cast(hour(ts) as string), ':', "
    "lpad(cast(minute(ts) as string), 2, '0'), ':', lpad(cast(second(ts) as string), 2, '0')) "
    "end raw from events",
}
_STAMP = "%Y-%m-%d %H:%M:%S"


def _typed(raw: str, expr):
    def query(spark, sf_dir):
        value = expr(_C("raw")).cast("string").alias("typed")
        return run(spark, sf_dir, RAW[raw]).select("id", "raw", value)

    return query


def _sql(raw: str, expr: str) -> str:
    return f"select id, raw, cast({expr} as varchar) typed from ({RAW[raw]}) r"


def _stamp(value):
    return F.date_format(value, "yyyy-MM-dd HH:mm:ss")


def typed_all(spark, sf_dir):
    df = with_typed(run(spark, sf_dir, TARGET), MAPPING, "target")
    return df.select(
        *[_C(c.target) for c in MAPPING.columns],
        *[_C(f"typed_{c.source}").cast("string").alias(f"typed_{c.source}") for c in MAPPING.columns],
    )


def norm_all(spark, sf_dir):
    return with_norm(run(spark, sf_dir, TARGET), MAPPING, "target")


def norm_text_query(spark, sf_dir):
    df = run(spark, sf_dir, TARGET)
    return df.select("ord_id", *[norm_text(_C(c)).alias(f"norm_{c}") for c in ("status_cd", "prio")])


def norm_numeric_query(spark, sf_dir):
    df = run(spark, sf_dir, TARGET)
    return df.select(*[norm_numeric(_C(c)).alias(f"norm_{c}") for c in ("ord_id", "price_amt")])


def norm_complex(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.array("l_partkey", "l_suppkey").alias("keys"),
        F.struct(_C("l_linenumber").alias("line"), _C("l_returnflag").alias("flag")).alias("info"),
    )
    fields = df.schema
    return df.select(
        "l_orderkey", *[norm_text(_C(c), fields[c].dataType).alias(c) for c in ("keys", "info")]
    )


def norm_embeddings(spark, sf_dir):
    df = table(spark, sf_dir, "embeddings")
    return df.select("vec_id", norm_text(_C("embedding"), df.schema["embedding"].dataType).alias("text"))


def norm_dates_as_text(spark, sf_dir):
    df = table(spark, sf_dir, "events").select("event_id", "ts", _C("ts").cast("date").alias("day"))
    return dates_as_text(df)


def row_hash_query(spark, sf_dir):
    df = with_norm(run(spark, sf_dir, TARGET), MAPPING, "target")
    values = [_C(f"norm_{c.source}") for c in MAPPING.compare]
    return df.select("ord_id", row_hash(*values).alias("row_hash"))


def scalar_trim(spark, sf_dir):
    return run(spark, sf_dir, TARGET).select("ord_id", ty.text(_C("status_cd")).alias("trimmed"))


def scalar_concat_ws(spark, sf_dir):
    df = run(spark, sf_dir, TARGET)
    return df.select("ord_id", F.concat_ws("||", "status_cd", "prio", "price_amt").alias("joined"))


def scalar_date_format(spark, sf_dir):
    df = table(spark, sf_dir, "events")
    return df.select("event_id", F.date_format("ts", "M/d/yyyy HH:mm:ss").alias("shown"))


def scalar_conditional(spark, sf_dir):
    df = run(spark, sf_dir, TARGET)
    return df.select(
        "ord_id",
        F.when(is_blank(_C("prio")), "blank").otherwise("present").alias("state"),
        F.coalesce("prio", F.lit("none")).alias("shown"),
    )


_LISTS = (
    "select o_orderkey, concat(' ', o_orderstatus, ', ,', o_orderpriority, ',') columns_text "
    "from orders"
)


def mismatched_columns_split(spark, sf_dir):
    df = run(spark, sf_dir, _LISTS)
    return df.select("o_orderkey", F.explode(split_list(_C("columns_text"))).alias("column_name"))


_TYPED_ALL = ", ".join(
    f"cast({sql_typed(c.target, c.kind)} as varchar) typed_{c.source}" for c in MAPPING.columns
)
_NORM_ALL = ", ".join(f"{sql_norm(c.target, c.kind)} norm_{c.source}" for c in MAPPING.columns)
_NORMS = ", ".join(sql_norm(c.target, c.kind) for c in MAPPING.compare)
_YES = "('true', 't', 'yes', 'y', '1')"
_NO = "('false', 'f', 'no', 'n', '0')"

QUERIES = {
    "typed_numeric": (
        _typed("numeric", ty.as_numeric),
        _sql("numeric", sql_typed("raw", "numeric")),
    ),
    "typed_integer": (_typed("whole", ty.as_integer), _sql("whole", sql_typed("raw", "integer"))),
    "typed_double": (
        _typed("whole", lambda c: ty.as_double(c).cast("decimal(18,2)")),
        _sql("whole", "cast(try_cast(trim(raw) as double) as decimal(18,2))"),
    ),
    "typed_boolean": (
        _typed("boolean", ty.as_boolean),
        _sql(
            "boolean",
            f"case when lower(trim(raw)) in {_YES} then true "
            f"when lower(trim(raw)) in {_NO} then false end",
        ),
    ),
    "typed_date": (_typed("date", ty.as_date), _sql("date", sql_typed("raw", "date"))),
    "typed_timestamp": (
        _typed("timestamp", lambda c: _stamp(ty.as_timestamp(c))),
        _sql("timestamp", f"strftime(try_cast(trim(raw) as timestamp), '{_STAMP}')"),
    ),
    "typed_string": (_typed("string", ty.text), _sql("string", "trim(raw)")),
    "typed_date_fmt": (
        _typed("us_date", lambda c: ty.as_date(c, "M/d/yyyy")),
        _sql("us_date", "cast(try_strptime(trim(raw), '%m/%d/%Y') as date)"),
    ),
    "typed_ts_fmt": (
        _typed("us_time", lambda c: _stamp(ty.as_timestamp(c, "M/d/yyyy H:mm:ss"))),
        _sql("us_time", f"strftime(try_strptime(trim(raw), '%m/%d/%Y %H:%M:%S'), '{_STAMP}')"),
    ),
    "typed_all": (typed_all, f"select *, {_TYPED_ALL} from ({TARGET}) x"),
    "norm_all": (norm_all, f"select *, {_NORM_ALL} from ({TARGET}) x"),
    "norm_text": (
        norm_text_query,
        "select ord_id, coalesce(trim(status_cd), '') norm_status_cd, "
        f"coalesce(trim(prio), '') norm_prio from ({TARGET}) x",
    ),
    "norm_numeric": (
        norm_numeric_query,
        f"select {sql_norm('ord_id', 'numeric')} norm_ord_id, "
        f"{sql_norm('price_amt', 'numeric')} norm_price_amt from ({TARGET}) x",
    ),
    "norm_complex": (
        norm_complex,
        "select l_orderkey, concat('[', l_partkey, ',', l_suppkey, ']') keys, "
        "concat('{\"line\":', l_linenumber, ',\"flag\":\"', l_returnflag, '\"}') info from lineitem",
    ),
    "norm_embeddings": (norm_embeddings, None),
    "norm_dates_as_text": (
        norm_dates_as_text,
        f"select event_id, strftime(ts, '{_STAMP}') ts, strftime(ts, '%Y-%m-%d') as day from events",
    ),
    "row_hash": (
        row_hash_query,
        f"select ord_id, sha256(concat_ws('||', {_NORMS})) row_hash from ({TARGET}) x",
    ),
    "scalar_trim": (scalar_trim, f"select ord_id, trim(status_cd) trimmed from ({TARGET}) x"),
    "scalar_concat_ws": (
        scalar_concat_ws,
        f"select ord_id, concat_ws('||', status_cd, prio, price_amt) joined from ({TARGET}) x",
    ),
    "scalar_date_format": (
        scalar_date_format,
        "select event_id, strftime(ts, '%-m/%-d/%Y %H:%M:%S') shown from events",
    ),
    "scalar_conditional": (
        scalar_conditional,
        "select ord_id, case when prio is null or trim(prio) = '' then 'blank' else 'present' end "
        f"state, coalesce(prio, 'none') shown from ({TARGET}) x",
    ),
    "mismatched_columns_split": (
        mismatched_columns_split,
        "select o_orderkey, column_name from (select o_orderkey, trim(unnest(string_split("
        f"columns_text, ','))) column_name from ({_LISTS}) l) where column_name <> ''",
    ),
}
