import json
from pathlib import Path

import pytest
from conftest import values
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel import ColumnMap, Mapping
from evenkeel.operators import history
from evenkeel.plans.prepare import JoinPlan, JoinStep, full_chain, join_tables, prepare_from, route
from evenkeel.queries.filing import _SUPPLIER, _supplier_files
from evenkeel.sources import documents as D
from evenkeel.sources import load as L
from evenkeel.sources import save as S

MAPPING = Mapping.of(
    ["id"],
    [ColumnMap("name", "name"), ColumnMap("id", "id", "integer"), ColumnMap("day", "day", "date", "M/d/yyyy")],
)


def test_declared_reads_find_columns_by_name(spark, tmp_path):
    (tmp_path / "t.csv").write_text("day,id,name\n1/2/2020,7, a b \nbad,x,\n")
    found = L.read_declared(spark, str(tmp_path / "t.csv"), MAPPING, "source")
    assert values(found.select("id", F.col("day").cast("string"), "name")) == [
        (None, None, None),
        (7, "2020-01-02", "a b"),
    ]
    rows = [{"id": 7, "day": "1/2/2020"}, {"id": "8", "name": "b"}]
    (tmp_path / "t.json").write_text(json.dumps(rows, indent=1))
    found = L.read_declared(spark, str(tmp_path / "t.json"), MAPPING, "source", multiline=True)
    assert values(found.select("id", "name")) == [(7, None), (8, "b")]


def test_json_documents_and_lines(spark, tmp_path):
    (tmp_path / "t.json").write_text(json.dumps([{"a": 1}, {"a": 2}], indent=1))
    assert values(L.load(spark, str(tmp_path / "t.json"))) == [(1,), (2,)]
    (tmp_path / "l.json").write_text('\n{"a": 1}\n{"a": 2}\n')
    assert values(L.load(spark, str(tmp_path / "l.json"))) == [(1,), (2,)]


def test_json_mode_of_every_file(spark, tmp_path):
    folder = tmp_path / "both.json"
    folder.mkdir()
    (folder / "a 1%.json").write_text(json.dumps([{"a": 1, "b": {"c": 1}}, {"a": 2}], indent=1))
    (folder / "b[x].json").write_text('\n{"a": 3}\n{"a": 4.5, "b": {"d": "x"}}\n{"a": 5}\n')
    (folder / "c.json").write_text('[{"a": 6}, {"a": 7}]\n')
    (folder / "d.json").write_text("{\n\"a\": 8\n}\n")
    (folder / "e.json").write_text("")
    (folder / "f.json").write_text('\ufeff{"a": 9}\n{"a": 10}\n', encoding="utf-8")
    found = L.load(spark, str(folder))
    assert sorted(r.a for r in found.collect()) == [1, 2, 3, 4.5, 5, 6, 7, 8, 9, 10]
    assert sorted((r.a, r.b.c, r.b.d) for r in found.filter("b is not null").collect()) == [(1, 1, None), (4.5, None, "x")]
    assert "_corrupt_record" not in found.columns


def test_pretty_documents_whose_first_line_holds_more_than_a_brace(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"a": 1,\n "b": 2}')
    assert values(L.load(spark, str(tmp_path / "p.json"))) == [(1, 2)]


def test_documents_of_all_layouts(spark, tmp_path):
    """Nested values, types that differ, odd names, torn lines, empty arrays; more lines than one split holds."""
    folder = tmp_path / "all.json"
    folder.mkdir()
    (folder / "a.json").write_text('{"a": 1,\n "x y": {"c": [1, 2]},\n "m": 1}')
    (folder / "b.json").write_text('[]\n{"a": 2.5, "m": "t"}\n{"a": \n')
    (folder / "c.json").write_text('[\n {"a": null},\n {"a": 4, "x y": {"c": [], "d": "e\\nf"}, "m": {"k": 1}}\n]')
    (folder / "d.json").write_text("\n \n")
    (folder / "e.json").write_text("".join(f'{{"a": {i}}}\n' for i in range(100, 600)))
    found = D.read_documents(spark, str(folder))
    assert sorted(found.columns) == ["a", "m", "x y"] and found.schema["a"].dataType.simpleString() == "double"
    rows = {r.a: r for r in found.collect()}
    assert found.count() == 505 and set(rows) >= {1, 2.5, 4, *range(100, 600)}
    assert rows[1]["x y"].c == [1, 2] and rows[4]["x y"].d == "e\nf" and rows[4]["x y"].c == []
    assert (rows[1].m, rows[2.5].m, rows[4].m) == ("1", "t", '{"k":1}')
    assert values(L.load(spark, str(folder))) == values(found)
    text = T.StructType([T.StructField("a", T.StringType())])
    assert sorted(r.a for r in D.read_documents(spark, str(folder), text).filter("length(a) < 3 or a = '2.5'").collect()) == ["1", "2.5", "4"]
    none = tmp_path / "none.json"
    none.mkdir()
    (none / "x.json").write_text("")
    assert D.read_documents(spark, str(none)).count() == 0


def test_many_documents_have_the_schema_that_the_reader_infers(spark, tmp_path):
    folder = tmp_path / "many.json"
    folder.mkdir()
    for i in range(L.FEW + 8):
        (folder / f"{i}.json").write_text(json.dumps([{"a": i, "b": {"c": [i / 2]}}, {"z": None, f"n{i % 3}": "x"}], indent=1))
    (folder / "big.json").write_text('{\n"a": 9223372036854775808,\n "b": {"d": true}}')
    (folder / "mark.json").write_text('\ufeff{\n"a": 1,\n "t": "x"}\n', encoding="utf-8")
    (folder / "none.json").write_text("")
    plain = spark.read.option("multiLine", True)
    assert D.schema_of_documents(spark, str(folder)) == plain.json(str(folder)).schema
    assert values(L.load(spark, str(folder))) == values(plain.json(str(folder)))
    (folder / "torn.json").write_text('{\n"a": }')
    assert D.schema_of_documents(spark, str(folder)) == plain.json(str(folder)).schema
    assert "_corrupt_record" in L.load(spark, str(folder)).columns


def test_supplier_documents_are_files_of_one_folder(spark, tmp_path):
    """Ten objects of one key in ten have a file each, beside their arrays; copies of a key too."""
    names = "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"
    rows = [(i, f'n"{i}', i % 25, i / 4) for i in range(100)] + [(10, "copy", 1, 0.5)]
    spark.createDataFrame(rows, names).write.parquet(str(tmp_path / "supplier.parquet"))
    for pretty_only, wanted in ((True, {"layout=document": 13}), (False, {"layout=document": 13, "layout=line": 0})):
        path = Path(_supplier_files(spark, str(tmp_path), pretty_only))
        folders = {p.name: sum(f.stat().st_size > 0 for f in p.glob("part-*")) for p in path.iterdir()}
        assert folders.keys() == wanted.keys() and folders["layout=document"] == wanted["layout=document"]
        assert values(L.load(spark, str(path)).select(*_SUPPLIER)) == sorted(rows, key=lambda r: [(True, str(v)) for v in r])


@pytest.mark.parametrize("first", ['{"a": 1, "b', '"a": 1}', '{"a": {"b": 1}'])
def test_json_of_unclear_mode_is_an_error(spark, tmp_path, first):
    path = tmp_path / "t.json"
    path.write_text(first + '\n{"a": 2}\n{"a": 3}\n', encoding="utf-8")
    with pytest.raises(ValueError, match="multiline"):
        L.load(spark, str(path))
    assert L.load(spark, str(path), multiline=False).count() == 3


def test_csv_texts_come_back(spark, tmp_path):
    rows = [(1, 'a "b"\nc,d'), (2, "\\"), (3, 'x\\"'), (4, '"'), (5, "\n\n"), (6, " a\r\nb ")]
    path = S.save(spark.createDataFrame(rows, "id int, t string"), str(tmp_path / "t.csv"), "csv")
    assert values(L.load(spark, path)) == [(str(i), t) for i, t in rows]


def test_formats():
    assert L.detect_format("/a/b.CSV") == "csv"
    assert L.detect_format("table:db.t") == "table"
    assert L.detect_format("jdbc:orders") == "jdbc"
    with pytest.raises(ValueError):
        L.detect_format("/a/b.xlsx")


def test_jdbc_options():
    plain = L.jdbc_options("jdbc:x", "orders", user="u")
    assert plain == {"url": "jdbc:x", "dbtable": "orders", "user": "u"}
    split = L.jdbc_options("jdbc:x", "orders", split_by="id", bounds=(1, 100), splits=8)
    assert split["partitionColumn"] == "id" and split["numPartitions"] == "8"
    with pytest.raises(ValueError):
        L.jdbc_options("jdbc:x", "orders", split_by="id")


def test_table_reference(spark):
    spark.range(3).createOrReplaceTempView("three_rows")
    assert L.load(spark, "table:three_rows").count() == 3


def test_text_sinks(spark, tmp_path):
    df = spark.sql("select 1 id, date'2020-03-04' day, cast(null as string) name, '  x ' pad")
    path = S.save_reconciled(df, str(tmp_path / "o.csv"), "csv", MAPPING)
    lines = [r.value for r in spark.read.text(path).collect()]
    assert lines == ["id,day,name,pad", "1,3/4/2020,,  x "]
    path = S.save_reconciled(df, str(tmp_path / "o.json"), "json", MAPPING)
    row = json.loads(spark.read.text(path).first().value)
    assert row == {"id": 1, "day": "3/4/2020", "name": None, "pad": "  x "}
    path = S.save_reconciled(df, str(tmp_path / "o.parquet"), "parquet", MAPPING)
    assert spark.read.parquet(path).dtypes == df.dtypes


@pytest.mark.parametrize("empty", ["limit", "partitions"])
def test_empty_csv_has_a_header(spark, tmp_path, empty):
    df = spark.sql("select 1 a, 'x' b")
    df = df.limit(0) if empty == "limit" else spark.createDataFrame(spark.sparkContext.emptyRDD(), df.schema)
    path = S.save(df, str(tmp_path / "e"), "csv")
    assert [r.value for r in spark.read.text(path).collect()] == ["a,b"]
    assert L.read_csv(spark, path).columns == ["a", "b"]


def test_backup_and_single_file(spark, tmp_path):
    path = S.save(spark.range(100).repartition(4), str(tmp_path / "t.parquet"), single=True)
    assert len(spark.read.parquet(path).inputFiles()) == 1
    copy = S.backup(spark, path, str(tmp_path / "copy"))
    assert spark.read.parquet(copy).count() == 100


@pytest.fixture
def tables(spark):
    return {
        "orders": spark.sql("select * from values (1, 10), (2, 20), (3, null) t(order_id, customer_id)"),
        "customers": spark.sql("select * from values (10, 'A'), (30, 'C') t(id, name)"),
        "payments": spark.sql("select * from values (1, 5), (1, 6), (9, 7) t(order_id, amount)"),
    }


PLAN = {
    "sources": [{"name": n, "type": "s3", "path": f"{n}.csv"} for n in ("orders", "customers", "payments", "unused")],
    "join_steps": [
        {"left": "orders", "right": "customers", "left_key": "customer_id", "right_key": "id", "type": "inner"},
        {"left": "result", "right": "payments", "left_key": "order_id", "right_key": "order_id", "type": "left"},
    ],
    "select_columns": ["orders.order_id", "customers.name", "payments.amount"],
    "column_mapping": {
        "orders.order_id": "order_id",
        "customers.name": "customer_name",
        "payments.amount": "amount",
    },
    "target": {"type": "s3", "path": "final.csv"},
}


def test_join_plan_reads_only_what_it_needs(spark, tmp_path, tables):
    plan = json.loads(json.dumps(PLAN).replace('"path": "', f'"path": "{tmp_path}/'))
    for name, df in tables.items():
        S.save(df, f"{tmp_path}/{name}.csv", "csv")
    S.save(spark.sql("select 1 order_id, 'A' customer_name, 5 amount, 0 other"), f"{tmp_path}/final.csv", "csv")
    source, target = prepare_from(spark, JoinPlan.from_json({"multi_source_workflow": plan}))
    assert values(source) == [("1", "A", "5"), ("1", "A", "6")]
    assert target.columns == ["order_id", "customer_name", "amount"]


@pytest.mark.parametrize(
    "how, wanted",
    [
        ("inner", [(1, "A")]),
        ("left", [(1, "A"), (2, None), (3, None)]),
        ("right", [(None, "C"), (1, "A")]),
        ("full_outer", [(None, "C"), (1, "A"), (2, None), (3, None)]),
        ("cross", [(1, "A")]),
    ],
)
def test_join_types(tables, how, wanted):
    step = JoinStep("orders", "customers", "customer_id", "id", how)
    found = join_tables(tables, (step,)).select("`orders.order_id`", "`customers.name`")
    assert values(found) == wanted


def test_right_only_rows_keep_the_key_of_the_result(spark):
    tables = {
        n: spark.sql(f"select * from values {v} t(id)")
        for n, v in (("a", "(1), (2)"), ("b", "(2), (3)"), ("c", "(3), (4)"))
    }
    for how, wanted in (
        ("full", [(None, None, 4), (None, 3, 3), (1, None, None), (2, 2, None)]),
        ("right", [(None, None, 4), (None, 3, 3)]),
    ):
        steps = (JoinStep("a", "b", "id", "id", how), JoinStep("result", "c", "id", "id", how))
        assert values(join_tables(tables, steps)) == wanted


@pytest.mark.parametrize("copies", [1, 3])
def test_grouped_full_chain_equals_the_joins(spark, copies):
    """Keys that are unique, repeated, NULL, or in some tables only; a table of equal columns and an empty one."""
    a = [(i, f"a{i}") for i in range(0, 30, 2)] + [(None, "lone")] * copies
    b = [(i, f"b{i}{j}") for i in range(0, 30, 3) for j in range(copies if i == 6 else 1)] + [(None, None)]
    c = [(i, f"c{i}{j}") for i in range(0, 30, 5) for j in range(copies if i < 11 else 1)] + [(None, "c")]
    tables = {
        "a": spark.createDataFrame(a, "id int, v string"),
        "b": spark.createDataFrame(b, "k bigint, v string"),
        "c": spark.createDataFrame(c, "id int, w string"),
    }
    steps = (JoinStep("a", "b", "id", "k", "full"), JoinStep("result", "c", "id", "id", "outer"))
    wanted = join_tables(tables, steps)
    found = full_chain(tables, steps)
    assert found.columns == wanted.columns and values(found) == values(wanted)
    none = {t: df.limit(0) for t, df in tables.items()}
    assert full_chain(none, steps).count() == 0
    with pytest.raises(ValueError):
        full_chain(tables, (JoinStep("a", "b", "id", "k", "left"),))


def test_semi_anti_and_bad_joins(tables):
    for how, wanted in (("left_semi", [(1,)]), ("anti", [(2,), (3,)])):
        step = JoinStep("orders", "customers", "customer_id", "id", how)
        assert values(join_tables(tables, (step,)).select("`orders.order_id`")) == wanted
    with pytest.raises(ValueError, match="unknown join"):
        join_tables(tables, (JoinStep("orders", "customers", "customer_id", "id", "asof"),))
    with pytest.raises(ValueError, match="no joined table"):
        join_tables(tables, (JoinStep("orders", "customers", "nothing", "id"),))
    assert route({}) == "single_pair" and route({"workflow_type": "multi_source"}) == "multi_source"


def run(stage, run_id, ts, **fields):
    names = (
        "source_count target_count total_mismatch extra_records_in_source extra_records_in_target "
        "source_duplicate_keys target_duplicate_keys row_count_status schema_drift_status source_format "
        "target_format initial_target_count final_target_count total_inserts total_updates overall_status"
    ).split()
    row = {"pipeline": "p", "stage": stage, "run_id": run_id, "run_ts": ts}
    return {**row, **{n: (None if fields.get(n) is None else str(fields[n])) for n in names}}


@pytest.fixture
def stages(spark):
    rows = [
        run("validation", "1", "2024-01-01 00:00:00", source_count=1),
        run("validation", "2", "2024-01-02 00:00:00", source_count=25, target_count="23.0", total_mismatch=4,
            extra_records_in_target=2, schema_drift_status="FAIL", overall_status="FAIL", source_format="csv"),
        run("reconciliation", "3", "2024-01-03 00:00:00", total_inserts=2, total_updates=4,
            initial_target_count=23, final_target_count=25),
        run("revalidation", "4", "2024-01-04 00:00:00", source_count=25, target_count=25, total_mismatch=0,
            schema_drift_status="PASS", extra_records_in_target="n/a", overall_status="PASS"),
    ]
    df = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in rows[0]))
    df = df.withColumn("run_ts", F.col("run_ts").cast("timestamp"))
    newest = {r.stage: r.run_id for r in history.latest_run(df).collect()}
    assert newest == {"validation": "2", "reconciliation": "3", "revalidation": "4"}
    return history.latest_stages(df)


def test_closure(stages):
    assert [tuple(r)[1:] for r in history.closure_business(stages).collect()] == [
        ("Row count", "Δ 2", "Inserted 2 missing rows", "Δ 0", "None"),
        ("Value mismatch", "4 mismatches", "4 rows updated", "0 mismatches", "None"),
        ("Schema drift", "FAIL", "Schema aligned", "PASS", "None"),
        ("Deletion in target", "2", "2 rows deleted", "0", "None"),
    ]
    executive = history.closure_executive(stages).first()
    assert executive.reconciliation_status == "PASS" and executive.source_format == "csv"
    assert executive.validation_run_timestamp == "2024-01-02 00:00:00"
    compared = {r.stage: r for r in history.closure_comparative(stages).collect()}
    assert compared["Reconciliation"].source_record_count == 23
    assert compared["Validation"].duplicate_keys == "0/0"
    issues = history.closure_issues(stages).first()
    assert issues.unresolved_mismatches.startswith("All mismatches")


def test_cost(spark):
    runs = spark.sql(
        "select 'e' execution_id, v dpu_seconds, timestamp'2024-01-01 00:00:00' started, "
        "timestamp'2024-01-01 01:00:00' ended from values ('3600'), ('x'), (null) t(v)"
    )
    row = history.run_cost(runs).first()
    assert row.duration_sec == 3600
    assert row.compute_cost == pytest.approx(0.44)
    assert row.total_cost == pytest.approx(0.44 + 0.0002 + 0.0000005)
