import pytest
from conftest import values
from pyspark.sql import types as T

from evenkeel import ColumnMap, Mapping
from evenkeel.operators import drift, layout


def types(spark, rows):
    return spark.createDataFrame(
        [("p", f"c{i}", *r) for i, r in enumerate(rows)],
        "pair string, column_name string, declared_data_type string, "
        "source_data_type string, target_data_type string",
    )


def verdicts(df):
    rows = sorted(df.collect(), key=lambda r: int(r.column_name[1:]))
    return [(r.drift_type, r.status) for r in rows]


def test_exact(spark):
    rows = [("string", "int", "int"), ("string", "int", "bigint"), ("string", None, "int"), ("string", "int", None)]
    assert verdicts(drift.drift_exact(types(spark, rows))) == [
        ("NO_DRIFT", "PASS"),
        ("DATA_TYPE_MISMATCH", "FAIL"),
        ("MISSING_IN_SOURCE", "FAIL"),
        ("MISSING_IN_TARGET", "FAIL"),
    ]


def test_family(spark):
    rows = [
        ("numeric", "int", "decimal(10,2)"),
        ("numeric", "string", "int"),
        ("date", "timestamp_ntz", "string"),
        ("string", "varchar(10)", "string"),
        ("boolean", "boolean", "boolean"),
        ("integer", "string", "map<int,int>"),
    ]
    found = drift.drift_family(types(spark, rows))
    warn = ("COMPATIBLE_TYPE_VARIATION", "WARN")
    assert verdicts(found) == [
        warn, ("DECLARED_TYPE_INCOMPATIBLE", "FAIL"), warn, warn, ("NO_DRIFT", "PASS"), warn,
    ]
    counts = drift.drift_check(found).first()
    assert (counts.total_drift_columns, counts.total_warn_columns, counts.status) == (1, 4, "FAIL")


def test_typed(spark):
    rows = [
        ("numeric", "decimal(38,10)", "decimal(38,10)"),
        ("int", "bigint", "int"),
        ("other", "string", "string"),
        ("date", None, "date"),
    ]
    assert verdicts(drift.drift_typed(types(spark, rows))) == [
        ("NO_DRIFT", "PASS"),
        ("DECLARED_TYPE_CAST_MISMATCH", "FAIL"),
        ("NO_DRIFT", "PASS"),
        ("MISSING_TYPED_COLUMN_IN_SOURCE", "FAIL"),
    ]


def test_catalog_of_real_tables(spark):
    mapping = Mapping.of(["a"], [ColumnMap("a", "x", "integer"), ColumnMap("b", "y", "numeric")])
    source = spark.sql("select 1 a, 2.5 b")
    target = spark.sql("select 1L x")
    catalog = drift.column_catalog(spark, source, "p", "source", mapping).unionByName(
        drift.column_catalog(spark, target, "p", "target", mapping)
    )
    found = drift.column_types(drift.declared_columns(spark, "p", mapping), catalog)
    assert values(drift.drift_exact(found).select("column_name", "drift_type")) == [
        ("a", "DATA_TYPE_MISMATCH"),
        ("b", "MISSING_IN_TARGET"),
    ]


def test_flatten(spark):
    df = spark.sql(
        "select struct(1 as b, struct(2 as d, array(3) as e) as c) as a, map('k', 1) m, 5 z"
    )
    flat = layout.flatten_nested(df)
    assert flat.columns == ["a_b", "a_c_d", "a_c_e", "m", "z"]
    assert tuple(flat.first()) == (1, 2, "[3]", '{"k":1}', 5)
    deep = layout.flatten_nested(df, max_depth=1)
    assert deep.columns == ["a_b", "a_c", "m", "z"]
    assert isinstance(deep.schema["a_c"].dataType, T.StructType)
    with pytest.raises(ValueError, match="a_b"):
        layout.flatten_nested(spark.sql("select struct(1 as b) a, 2 a_b"))


def test_layouts(spark):
    target = spark.sql("select 'x' extra, 1 b")
    source = spark.sql("select 'q' a, 2 b")
    assert tuple(layout.align_target_layout(target, source).first()) == (None, 1, "x")
    schema = T.StructType([T.StructField("b", T.StringType()), T.StructField("n", T.LongType())])
    found, absent = layout.project_to_schema(target, schema)
    assert tuple(found.first()) == ("1",) and absent == ["n"]
    assert tuple(layout.cast_to_schema(target, schema).first()) == ("x", "1")
    shown = layout.dates_as_text(spark.sql("select date'2020-01-02' d, timestamp'2020-01-02 03:04:05.6' t"))
    assert tuple(shown.first()) == ("2020-01-02", "2020-01-02 03:04:05")
