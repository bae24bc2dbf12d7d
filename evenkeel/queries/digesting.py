"""Queries that compare by digests, and keys with several rows as bags."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..mapping import ColumnMap, Mapping
from ..operators import digest
from ..plans.validation import Validation
from .checking import _COUNTS, CHECKS
from .comparing import QUERIES as _COMPARED
from .inputs import MAPPING, PAIR, pair, run


def classify_digest(spark, sf_dir):
    found = digest.classify_by_digest(*pair(spark, sf_dir), MAPPING)
    return found.select(
        F.col("_k0").alias("key"), "n_src", "n_tgt", "state", F.array_join("changed", ",").alias("changed")
    )


def validation_digest(spark, sf_dir):
    return Validation(*pair(spark, sf_dir), MAPPING, digest_levels=digest.LEVELS).checks


# Lines by order: every order has several rows, and a third of all orders go by one number. The source has
# exact copies of some lines; the target lacks some, doubles others and gives some another price.
_LINE = (
    "case when l_orderkey % 3 = 0 then 0 else l_orderkey end order_no, l_linenumber line, l_partkey part, l_suppkey supplier, "
    "cast(cast(l_quantity as decimal(18,2)) as string) quantity, "
    "cast(cast(l_extendedprice as decimal(18,2)){} as string) price, l_returnflag flag, l_linestatus state, "
    "cast(cast(l_shipdate as date) as string) shipped"
)
LEFT = f"""
select {_LINE.format("")} from lineitem
union all select {_LINE.format("")} from lineitem where l_orderkey % 89 = 0
"""
RIGHT = f"""
select {_LINE.format(" + case when l_partkey % 53 = 0 then 1 else 0 end")} from lineitem where l_suppkey % 17 <> 0
union all select {_LINE.format("")} from lineitem where l_partkey % 71 = 0
"""
_NAMES = "order_no line part supplier quantity price flag state shipped".split()
LINES = Mapping.of(
    ["order_no"],
    [ColumnMap(n, n, "integer" if n in ("order_no", "line", "part", "supplier") else "string") for n in _NAMES],
)


def _lines(read):
    return lambda spark, sf_dir: read(run(spark, sf_dir, LEFT), run(spark, sf_dir, RIGHT), LINES)


_TEXTS = ", ".join(f"cast({n} as varchar) {n}" for n in _NAMES)
_BAGS = f"""
with s as (select {_TEXTS}, count(*) n from ({LEFT}) group by all),
t as (select {_TEXTS}, count(*) m from ({RIGHT}) group by all),
b as (select {", ".join(_NAMES)}, coalesce(n, 0) n, coalesce(m, 0) m from s full join t using ({", ".join(_NAMES)}))
"""

QUERIES = {
    "classify_digest": (classify_digest, _COMPARED["classify_rows"][1]),
    "validation_digest": (validation_digest, f"{PAIR}, {_COUNTS} {CHECKS}"),
    "bag_differences": (
        _lines(digest.bag_differences),
        f"{_BAGS} select {', '.join(_NAMES)}, 'source' side, unnest(generate_series(m + 1, n)) copy from b where n > m "
        f"union all select {', '.join(_NAMES)}, 'target', unnest(generate_series(n + 1, m)) from b where m > n",
    ),
    "bag_summary": (
        _lines(digest.bag_summary),
        f"{_BAGS} select sum(n)::bigint source_row_count, sum(m)::bigint target_row_count, sum(least(n, m))::bigint paired_copies, "
        "sum(greatest(n - m, 0))::bigint source_leftovers, sum(greatest(m - n, 0))::bigint target_leftovers from b",
    ),
}
