"""Queries that match columns by name and infer types. The catalog has one table pair per order."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.names import name_key
from ..operators import matching as M
from ..operators.profile import infer_types
from ..operators.sharing import match_by_values
from ..plans.generate import generate_mapping
from .inputs import run

_PAIR = "concat('pair_', cast(l_orderkey as string))"
_NAME = "concat(replace(p_name, ' ', '_'), '_', cast(l_linenumber as string))"

# Target names are spelled differently, have a letter more, lack some, or are something else.
CATALOG = f"""
select {_PAIR} pair, 'source' side, {_NAME} column_name, l_linenumber ordinal
from lineitem join part on p_partkey = l_partkey
union all
select {_PAIR} pair, 'target' side,
       case l_suppkey % 4 when 0 then upper(replace({_NAME}, '_', '-')) when 1 then concat({_NAME}, 's')
       when 2 then replace({_NAME}, 'e', '') else concat('zz', reverse({_NAME})) end column_name,
       l_linenumber + 10 ordinal
from lineitem join part on p_partkey = l_partkey
"""
# Wishes for columns that the names do not settle, some of them impossible.
OVERRIDES = f"""
select {_PAIR} pair, {_NAME} source_column,
       case when l_suppkey % 4 = 3 then concat('zz', reverse({_NAME})) else 'no_such_column' end
       target_column
from lineitem join part on p_partkey = l_partkey
"""


# The names of one side as a join, which the three texts above repeat.
_JOINED = f"""
select {_PAIR} pair, {_NAME} column_name, l_linenumber, l_suppkey from lineitem join part on p_partkey = l_partkey
"""
_SPELLED = """
case l_suppkey % 4 when 0 then upper(replace(column_name, '_', '-')) when 1 then concat(column_name, 's')
when 2 then replace(column_name, 'e', '') else concat('zz', reverse(column_name)) end
"""


def _catalog(spark, sf_dir):
    """The rows of CATALOG from one join of lines and parts."""
    return run(spark, sf_dir, _JOINED).selectExpr(
        "pair",
        "inline(array(named_struct('side', 'source', 'column_name', column_name, 'ordinal', l_linenumber), "
        f"named_struct('side', 'target', 'column_name', {_SPELLED}, 'ordinal', l_linenumber + 10)))",
    )


def name_key_query(spark, sf_dir):
    names = run(spark, sf_dir, CATALOG)
    return names.select("pair", "side", "column_name", name_key(F.col("column_name")).alias("key"))


def _similar(measure):
    def query(spark, sf_dir):
        catalog = _catalog(spark, sf_dir)
        sources, targets = (M.keyed_names(catalog, s) for s in ("source", "target"))
        found = M.similar_keys(sources, targets, measure)
        return found.select(
            "pair", "source_key", "target_key", F.round("score", 6).alias("score")
        )

    return query


def _matched(spark, sf_dir):
    wishes = run(spark, sf_dir, _JOINED).selectExpr(
        "pair", "column_name source_column",
        "case when l_suppkey % 4 = 3 then concat('zz', reverse(column_name)) else 'no_such_column' end target_column",
    )
    return M.match_columns(_catalog(spark, sf_dir), wishes, measure="levenshtein")


def column_match(spark, sf_dir):
    return _matched(spark, sf_dir).filter("match_type = 'one-to-one'")


def column_match_override(spark, sf_dir):
    return _matched(spark, sf_dir).filter("match_type = 'override'")


def column_match_unmapped(spark, sf_dir):
    return _matched(spark, sf_dir).filter("match_type like 'unmapped%'")


def column_match_sequence(spark, sf_dir):
    return M.match_columns(_catalog(spark, sf_dir))


_SAME_NAMES = f"""
select pair, case when side = 'source' then 'target' else 'source' end side, column_name, ordinal
from ({CATALOG}) c where ordinal < 3
"""


def _same_names(spark, sf_dir):
    """The rows of _SAME_NAMES from one join of lines and parts."""
    other = F.expr("case when side = 'source' then 'target' else 'source' end")
    return _catalog(spark, sf_dir).filter("ordinal < 3").withColumn("side", other)


def mapping_backfill(spark, sf_dir):
    """Here the targets of a pair are named like its first source columns."""
    mapping = _matched(spark, sf_dir).filter("source_column is not null")
    return M.backfill(mapping, _same_names(spark, sf_dir))


_DAY = "cast(month(o_orderdate) as string), '/', cast(day(o_orderdate) as string), '/', cast(year(o_orderdate) as string)"
PROFILED = f"""
select cast(o_orderkey as string) id, cast(cast(o_totalprice as decimal(18,2)) as string) price,
       case when o_orderkey % 2 = 0 then 'TRUE' else 'false' end flag,
       cast(cast(o_orderdate as date) as string) iso_day,
       concat({_DAY}) us_day,
       concat(lpad(cast(day(o_orderdate) as string), 2, '0'), '-',
              lpad(cast(month(o_orderdate) as string), 2, '0'), '-',
              cast(year(o_orderdate) as string)) eu_day,
       concat(cast(cast(o_orderdate as date) as string), ' 10:30') iso_time,
       concat({_DAY}, ' 9:05:00') us_time,
       o_orderpriority priority,
       case when o_orderkey % 3 = 0 then '' when o_orderkey % 3 = 1 then null
            else cast(o_custkey as string) end sparse,
       case when o_orderkey % 1000 = 7 then '1999-02-30'
            else cast(cast(o_orderdate as date) as string) end bad_day,
       case when o_orderkey % 2 = 0 then '7' else '7.5' end mixed,
       cast(null as string) nothing,
       o_custkey native_whole, o_totalprice native_double, cast(o_orderdate as timestamp) native_time
from orders
"""


def infer_types_query(spark, sf_dir):
    return infer_types(run(spark, sf_dir, PROFILED))


# Orders under names that tell nothing, as text, without some rows and with some other prices.
RENAMED = """
select cast(o_orderkey as string) a, cast(o_custkey as string) b, o_orderstatus c,
       case when o_orderkey % 50 = 0 then '1.5' else cast(cast(o_totalprice as decimal(18,2)) as string) end d,
       cast(cast(o_orderdate as date) as string) e, concat(' ', o_orderpriority) f, cast(null as string) g,
       cast(o_orderkey % 7 as string) h
from orders where o_orderkey % 97 <> 0
"""


def column_match_values(spark, sf_dir):
    """Renamed columns of orders, found by what they hold."""
    found = match_by_values(run(spark, sf_dir, "select * from orders"), run(spark, sf_dir, RENAMED))
    return found.withColumn("overlap", F.round("overlap", 9))


def generate_mapping_query(spark, sf_dir):
    """A mapping from the text table to one whose columns are spelled otherwise."""
    source = run(spark, sf_dir, PROFILED)
    target = source.select(
        *[F.col(c).alias(c.upper().replace("_", "")) for c in source.columns if c not in _RENAMED],
        *[F.col(c).alias(t) for c, t in _RENAMED.items()],
        F.lit(1).alias("load_batch"),
    )
    return generate_mapping(source, target, {"price": "amount", "flag": "no_such_column"})


_RENAMED = {"price": "amount", "flag": "marker"}


# --- SQL side -----------------------------------------------------------------------------------

_KEY = "regexp_replace(lower(column_name), '[^a-z0-9]+', '', 'g')"
_SIMILAR = f"""
with cat as ({CATALOG}),
k as materialized (select *, {_KEY} as key from cat),
f as (select * from (select *, row_number() over (partition by pair, side, key
      order by ordinal, column_name) rn from k) where rn = 1),
p as materialized (select s.pair, s.key source_key, t.key target_key, s.column_name source_column,
             t.column_name target_column, s.ordinal so, t.ordinal target_ordinal,
             case when greatest(length(s.key), length(t.key)) = 0 then 1.0 else
             1 - cast(levenshtein(s.key, t.key) as double) / greatest(length(s.key), length(t.key))
             end score
      from f s join f t on s.pair = t.pair and s.side = 'source' and t.side = 'target'),
q as (select * from p where score >= 0.9 - 1e-9)
"""
_MATCHED = f"""{_SIMILAR},
b as (select * from (select *, row_number() over (partition by pair, source_key
      order by round(score, 12) desc, target_ordinal, target_column) rn from q) where rn = 1),
m as (select pair, source_column, target_column, 'one-to-one' match_type from
      (select *, row_number() over (partition by pair, target_column order by so, source_column) r2
       from b) where r2 = 1),
fs as (select pair, column_name source_column, min(ordinal) ordinal from cat where side = 'source'
       and not exists (select 1 from m where m.pair = cat.pair and m.source_column = cat.column_name)
       group by 1, 2),
ft as (select distinct pair, column_name target_column from cat where side = 'target'
       and not exists (select 1 from m where m.pair = cat.pair and m.target_column = cat.column_name)),
w as (select pair, source_column, min(target_column) target_column from ({OVERRIDES}) group by 1, 2),
o as (select pair, source_column, target_column, 'override' match_type from
      (select w.*, row_number() over (partition by w.pair, w.target_column
       order by fs.ordinal, w.source_column) rn
       from w join fs on fs.pair = w.pair and fs.source_column = w.source_column
       join ft on ft.pair = w.pair and ft.target_column = w.target_column) where rn = 1),
u as (select pair, source_column, cast(null as varchar) target_column, 'unmapped_source' match_type
      from fs where not exists (select 1 from o where o.pair = fs.pair and
                                o.source_column = fs.source_column)
      union all
      select pair, null, target_column, 'unmapped_target' from ft
      where not exists (select 1 from o where o.pair = ft.pair and
                        o.target_column = ft.target_column))
"""

# What a text must look like, in SQL, by the order of precedence.
_LOOKS = [
    ("integer", "", "regexp_full_match({x}, '-?[0-9]+')"),
    ("double", "", "regexp_full_match({x}, '-?[0-9]+([.][0-9]+)?')"),
    ("boolean", "", "lower({x}) in ('true', 'false')"),
    (
        "timestamp",
        "yyyy-MM-dd H:mm[:ss]",
        "regexp_full_match({x}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}\\s+[0-9]{{2}}:[0-9]{{2}}(:[0-9]{{2}})?')",
    ),
    (
        "timestamp",
        "M/d/yyyy H:mm[:ss]",
        "regexp_full_match({x}, '[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}}\\s+[0-9]{{1,2}}:[0-9]{{2}}(:[0-9]{{2}})?')",
    ),
    (
        "date",
        "yyyy-MM-dd",
        "regexp_full_match({x}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') and try_cast({x} as date) is not null",
    ),
    (
        "date",
        "M/d/yyyy",
        "regexp_full_match({x}, '[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}}') and try_strptime({x}, '%m/%d/%Y') is not null",
    ),
    (
        "date",
        "dd-MM-yyyy",
        "regexp_full_match({x}, '[0-9]{{2}}-[0-9]{{2}}-[0-9]{{4}}') and try_strptime({x}, '%d-%m-%Y') is not null",
    ),
]
_TEXTS = (
    "id price flag iso_day us_day eu_day iso_time us_time priority sparse bad_day mixed nothing"
).split()


def _inferred(ordinal: int, column: str) -> str:
    x = f"nullif(trim({column}), '')"
    kind = " ".join(f"when bool_and({t.format(x=x)}) then '{k}'" for k, _, t in _LOOKS)
    fmt = " ".join(
        f"when bool_and({t.format(x=x)}) then " + (f"'{f}'" if f else "null") for _, f, t in _LOOKS
    )
    return (
        f"select '{column}' column_name, {ordinal} ordinal, case {kind} else 'string' end data_type, "
        f"case {fmt} end date_format from x"
    )


_INFERRED = " union all ".join(_inferred(i, c) for i, c in enumerate(_TEXTS)) + (
    f" union all select 'native_whole', {len(_TEXTS)}, 'integer', null"
    f" union all select 'native_double', {len(_TEXTS) + 1}, 'double', null"
    f" union all select 'native_time', {len(_TEXTS) + 2}, 'timestamp', 'yyyy-MM-dd HH:mm:ss'"
)

_ORDER_COLUMNS = "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority".split()


def _held(columns, table_name: str) -> str:
    text = "nullif(trim(cast({c} as varchar)), '')"
    value = f"coalesce(cast(try_cast({text} as decimal(38,10)) as varchar), regexp_replace({text}, ' 00:00:00$', ''))"
    return " union ".join(f"select '{c}' c, {value.format(c=c)} v from {table_name}" for c in columns)


_SHARED = f"""
with r as ({RENAMED}), s as (select * from ({_held(_ORDER_COLUMNS, 'orders')}) x where v is not null),
t as (select * from ({_held('abcdefgh', 'r')}) x where v is not null),
ns as (select c, count(*) n from s group by c), nt as (select c, count(*) n from t group by c),
b as (select s.c source_column, t.c target_column, count(*) shared_values from s join t using (v) group by all),
p as (select source_column, target_column, ns.n source_values, nt.n target_values, shared_values,
      shared_values / greatest(ns.n, nt.n) overlap from b join ns on ns.c = source_column join nt on nt.c = target_column),
q as (select *, row_number() over (partition by source_column order by overlap desc, shared_values desc, target_column) x,
      row_number() over (partition by target_column order by overlap desc, shared_values desc, source_column) y
      from p where overlap >= 0.5)
select source_column, target_column, source_values, target_values, shared_values, round(overlap, 9) overlap
from q where x = 1 and y = 1
"""

QUERIES = {
    "column_match_values": (column_match_values, _SHARED),
    "name_key": (
        name_key_query,
        f"select pair, side, column_name, {_KEY} as key from ({CATALOG}) c",
    ),
    "name_levenshtein": (
        _similar("levenshtein"),
        f"{_SIMILAR} select pair, source_key, target_key, round(score, 6) score from q",
    ),
    "name_similarity": (_similar("sequence"), None),
    "column_match": (column_match, f"{_MATCHED} select * from m"),
    "column_match_override": (column_match_override, f"{_MATCHED} select * from o"),
    "column_match_unmapped": (column_match_unmapped, f"{_MATCHED} select * from u"),
    "column_match_sequence": (column_match_sequence, None),
    "mapping_backfill": (
        mapping_backfill,
        f"{_MATCHED}, g as (select * from m union all select * from o union all select * from u), "
        f"h as (select distinct pair, column_name from ({_SAME_NAMES}) z where side = 'target') "
        "select g.pair, source_column, coalesce(target_column, column_name) target_column, "
        "match_type from g left join h on h.pair = g.pair and h.column_name = source_column "
        "where source_column is not null",
    ),
    "generate_mapping": (
        generate_mapping_query,
        f"with x as ({PROFILED}), y as ({_INFERRED}) select column_name source_column, "
        "case column_name when 'price' then 'amount' when 'flag' then null "
        "else upper(replace(column_name, '_', '')) end target_column, "
        "case column_name when 'price' then 'override' when 'flag' then 'unmapped_source' "
        "else 'one-to-one' end match_type, data_type, date_format from y "
        "union all values (null, 'marker', 'unmapped_target', null, null), "
        "(null, 'load_batch', 'unmapped_target', null, null)",
    ),
    "infer_types": (infer_types_query, f"with x as ({PROFILED}) {_INFERRED}"),
}
