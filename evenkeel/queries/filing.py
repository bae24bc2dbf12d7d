"""Queries that write given tables to a fresh folder and read them back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..mapping import ColumnMap, Mapping
from ..operators.compare import extra_in_source, key_presence
from ..operators.layout import rename_to_common
from ..operators.repair import plan_repair, repaired
from ..plans.validation import Validation
from ..sources import load as L
from ..sources import save as S
from .inputs import MAPPING, PAIR, SOURCE, TARGET, TARGET_COLUMNS, pair, run, table
from .repairing import ROWS, _APPLIED

_ORDERS = Mapping.of(
    ["o_orderkey"],
    [
        ColumnMap("o_orderpriority", "o_orderpriority"),
        ColumnMap("o_orderdate", "o_orderdate", "timestamp", "yyyy-MM-dd HH:mm:ss"),
        ColumnMap("o_orderkey", "o_orderkey", "integer"),
        ColumnMap("o_totalprice", "o_totalprice", "double"),
    ],
)
_SUPPLIER = ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"]
_STAMP = "yyyy-MM-dd HH:mm:ss"


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders")


def _shown(df):
    return df.select(
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
        F.col("o_totalprice").cast("double").alias("o_totalprice"),
        F.date_format("o_orderdate", _STAMP).alias("o_orderdate"),
        "o_orderpriority",
    )


def scan_csv_infer(spark, sf_dir):
    path = S.save(S.as_text(_orders(spark, sf_dir)), S.scratch(spark), "csv")
    return _shown(L.read_csv(spark, path, infer=True))


def scan_csv_declared(spark, sf_dir):
    """The file's column order differs from the mapping's; columns are found by name."""
    path = S.save(S.as_text(_orders(spark, sf_dir)), f"{S.scratch(spark)}.csv", "csv")
    return _shown(L.read_declared(spark, path, _ORDERS, "source"))


def scan_json(spark, sf_dir):
    path = S.save(S.as_text(_orders(spark, sf_dir)), f"{S.scratch(spark)}.json", "json")
    return _shown(L.read_declared(spark, path, _ORDERS, "source"))


def scan_csv_text(spark, sf_dir):
    """Texts with newlines and quotes survive being written and read."""
    path = S.save(table(spark, sf_dir, "documents"), f"{S.scratch(spark)}.csv", "csv")
    found = L.load(spark, path)
    return found.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), "source"
    )


def scan_json_multiline(spark, sf_dir):
    """The nations of each region as one document, an array over several lines."""
    nation = F.struct("n_nationkey", "n_name", "n_regionkey")
    nations = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.collect_list(nation).alias("n"))
    document = F.regexp_replace(F.to_json("n"), r"\},\{", "},\n{")
    path = f"{S.scratch(spark)}.json"
    nations.select(document.alias("value")).repartitionByRange(5, "value").write.text(path)
    return L.load(spark, path).select("n_nationkey", "n_name", "n_regionkey")


def _supplier_files(spark, sf_dir, pretty_only=False):
    """Suppliers as JSON: lines, arrays of up to 50 over several lines, and objects over several lines."""
    path = f"{S.scratch(spark)}.json"
    supplier = table(spark, sf_dir, "supplier")
    key, record = F.col("s_suppkey"), F.to_json(F.struct(*supplier.columns))
    # A value as JSON: the record of it alone, without braces and name.
    values = [F.regexp_extract(F.to_json(F.struct(F.col(c).alias("v"))), r'(?s)^\{"v":(.*)\}$', 1) for c in supplier.columns]
    shown = F.concat_ws(",\n ", *[F.concat(F.lit(f'"{c}": '), v) for c, v in zip(supplier.columns, values)])
    objects = supplier.filter(key % 10 == 0).select(F.concat(F.lit("{"), shown, F.lit("}")).alias("value"), F.concat(F.lit("o"), key).alias("doc"))
    rest = supplier.filter(key % 10 != 0)
    chosen = rest if pretty_only else rest.filter(key % 10 < 5)
    arrays = chosen.groupBy(F.floor(key / 50).alias("g")).agg(F.array_join(F.collect_list(record), ",\n").alias("rows"))
    arrays = arrays.select(F.concat(F.lit("[\n"), F.col("rows"), F.lit("\n]")).alias("value"), F.concat(F.lit("a"), F.col("g")).alias("doc"))
    # One file per document, all in one folder and written by all cores: a folder each takes far longer to write and list.
    tasks = 4 * spark.sparkContext.defaultParallelism
    documents = objects.unionByName(arrays).repartition(tasks, "doc").select("value")
    documents.write.option("maxRecordsPerFile", 1).text(f"{path}/layout=document")
    if not pretty_only:
        rest.filter(key % 10 >= 5).select(record.alias("value")).write.text(f"{path}/layout=line")
    return path


def scan_json_pretty(spark, sf_dir):
    return L.load(spark, _supplier_files(spark, sf_dir, pretty_only=True)).select(*_SUPPLIER)


def scan_json_mixed(spark, sf_dir):
    return L.load(spark, _supplier_files(spark, sf_dir)).select(*_SUPPLIER)


def scan_json_schema(spark, sf_dir):
    path = S.save(table(spark, sf_dir, "events"), S.scratch(spark), "json")
    schema = T.StructType(
        [T.StructField("value", T.DoubleType()), T.StructField("event_id", T.LongType())]
    )
    return L.read_json(spark, path, schema)


def scan_parquet(spark, sf_dir):
    found = L.read_parquet(spark, f"{sf_dir}/orders.parquet", merge_schema=True)
    return _shown(found)


def scan_parquet_merged(spark, sf_dir):
    """Files of different columns read as one table."""
    base = S.scratch(spark)
    orders = _orders(spark, sf_dir)
    S.save(orders.select("o_orderkey", "o_orderstatus"), f"{base}/part=1")
    S.save(orders.select("o_orderkey", "o_custkey"), f"{base}/part=2")
    return L.read_parquet(spark, base, merge_schema=True).select(
        "o_orderkey", "o_orderstatus", "o_custkey", F.col("part").cast("int").alias("part")
    )


def scan_by_suffix(spark, sf_dir):
    """Regions as csv, nations as json, suppliers as parquet, told apart by their suffix."""
    nations = table(spark, sf_dir, "nation")
    base = S.scratch(spark)
    region = S.save(table(spark, sf_dir, "region"), f"{base}/region.csv", "csv")
    nation = S.save(nations, f"{base}/nation.json", "json")
    supplier = f"{sf_dir}/supplier.parquet"
    suppliers, nations, regions = (L.load(spark, p) for p in (supplier, nation, region))
    joined = suppliers.join(nations, suppliers.s_nationkey == nations.n_nationkey).join(
        regions, nations.n_regionkey == regions.r_regionkey.cast("int")
    )
    return joined.select("s_suppkey", "n_name", "r_name")


def load_dispatch(spark, sf_dir):
    """The same pair stored in two formats and loaded by reference has the same keys."""
    source, target = pair(spark, sf_dir)
    base = S.scratch(spark)
    one = S.save(source, f"{base}/source.csv", "csv")
    two = S.save(target, f"{base}/target.json", "json")
    return extra_in_source(
        key_presence(L.load(spark, one), L.load(spark, two), MAPPING), MAPPING
    )


def sink_csv(spark, sf_dir):
    path = S.save(run(spark, sf_dir, TARGET), f"{S.scratch(spark)}.csv", "csv")
    found = L.load(spark, path)
    return found.select(*[F.coalesce(c, F.lit("")).alias(c) for c in found.columns])


def sink_csv_empty(spark, sf_dir):
    """The source compared with itself has no extra keys, and the file still has its header."""
    source, _ = pair(spark, sf_dir)
    same = Mapping.of(
        ["order_id"], [ColumnMap(c.source, c.source, c.data_type) for c in MAPPING.columns]
    )
    empty = extra_in_source(key_presence(source, source, same), same)
    path = S.save(empty, S.scratch(spark), "csv")
    header = spark.read.text(path).distinct()
    return header.select(F.col("value").alias("header"))


def sink_parquet(spark, sf_dir):
    path = S.save(run(spark, sf_dir, TARGET), f"{S.scratch(spark)}.parquet")
    return L.load(spark, path)


def sink_reconciled(spark, sf_dir):
    """The repaired target as JSON lines, NULL fields kept."""
    source, target = pair(spark, sf_dir)
    fixed = repaired(plan_repair(target, source, MAPPING))
    path = S.save_reconciled(fixed, f"{S.scratch(spark)}.json", "json", MAPPING)
    return L.load(spark, path).select(*TARGET_COLUMNS)


def sink_bundle(spark, sf_dir):
    """Two details of a validation run, written and read back."""
    run_ = Validation(*pair(spark, sf_dir), MAPPING)
    paths = S.save_bundle(
        {"only_source": run_.extra_in_source, "only_target": run_.extra_in_target}, S.scratch(spark)
    )
    parts = [
        spark.read.parquet(path).select(F.lit(name).alias("detail"), "order_id")
        for name, path in paths.items()
    ]
    return parts[0].unionByName(parts[1])


def sink_backup(spark, sf_dir):
    base = S.scratch(spark)
    path = S.save(run(spark, sf_dir, TARGET), f"{base}/target.parquet")
    copy = S.backup(spark, path, f"{base}/target.backup.parquet")
    return rename_to_common(spark.read.parquet(copy), MAPPING, "target")


_SHOWN = (
    "select o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') o_orderdate, "
    "o_orderpriority from orders"
)
_BLANKS = ", ".join(f"coalesce({c}, '') {c}" for c in TARGET_COLUMNS)
_RENAMED = ", ".join(f"{c.target} {c.source}" for c in MAPPING.columns)

QUERIES = {
    "scan_csv_infer": (scan_csv_infer, _SHOWN),
    "scan_csv_declared": (scan_csv_declared, _SHOWN),
    "scan_json": (scan_json, _SHOWN),
    "scan_csv_text": (scan_csv_text, "select doc_id, coalesce(text, '') as text, source from documents"),
    "scan_json_multiline": (scan_json_multiline, "select n_nationkey, n_name, n_regionkey from nation"),
    "scan_json_pretty": (scan_json_pretty, f"select {', '.join(_SUPPLIER)} from supplier"),
    "scan_json_mixed": (scan_json_mixed, f"select {', '.join(_SUPPLIER)} from supplier"),
    "scan_json_schema": (scan_json_schema, "select value, event_id from events"),
    "scan_parquet": (scan_parquet, _SHOWN),
    "scan_parquet_merged": (
        scan_parquet_merged,
        "select o_orderkey, o_orderstatus, cast(null as bigint) o_custkey, 1 part from orders "
        "union all select o_orderkey, null, o_custkey, 2 from orders",
    ),
    "scan_by_suffix": (
        scan_by_suffix,
        "select s_suppkey, n_name, r_name from supplier join nation on s_nationkey = n_nationkey "
        "join region on n_regionkey = r_regionkey",
    ),
    "load_dispatch": (load_dispatch, f"{PAIR} select order_id from c where n_tgt = 0"),
    "sink_csv": (sink_csv, f"select {_BLANKS} from ({TARGET}) x"),
    "sink_csv_empty": (
        sink_csv_empty,
        f"select 'order_id' header where (select count(*) from ({SOURCE}) x) > 0",
    ),
    "sink_parquet": (sink_parquet, f"select * from ({TARGET}) x"),
    "sink_reconciled": (sink_reconciled, f"{ROWS} {_APPLIED}"),
    "sink_bundle": (
        sink_bundle,
        f"{PAIR} select 'only_source' detail, order_id from c where n_tgt = 0 "
        "union all select 'only_target', ord_id from c where n_src = 0",
    ),
    "sink_backup": (sink_backup, f"select {_RENAMED} from ({TARGET}) x"),
}
