import datetime as dt
from decimal import Decimal

import pytest

from pyspark.sql import functions as F

from evenkeel.functions import typed as ty
from evenkeel.functions.lenient import lenient_int, split_list
from evenkeel.functions.normalize import norm, row_hash
from evenkeel.mapping import ColumnMap, Mapping, MappingError


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first().v


@pytest.mark.parametrize(
    "kind, raw, wanted",
    [
        ("numeric", " 1.50 ", Decimal("1.5000000000")),
        ("numeric", "1e3", Decimal("1000.0000000000")),
        ("numeric", ".5", Decimal("0.5000000000")),
        ("numeric", "1" * 29, None),
        ("numeric", "n/a", None),
        ("numeric", "", None),
        ("numeric", None, None),
        ("integer", "1.9", 1),
        ("integer", "-1.9", -1),
        ("integer", "+7", 7),
        ("integer", "9223372036854775807", 9223372036854775807),
        ("integer", "9223372036854775808", None),
        ("integer", "1e3", None),
        ("double", "1.5e2", 150.0),
        ("double", "-Infinity", float("-inf")),
        ("double", "1,5", None),
        ("boolean", " Yes ", True),
        ("boolean", "0", False),
        ("boolean", "maybe", None),
        ("date", "2020-02-29", dt.date(2020, 2, 29)),
        ("date", "2021-02-29", None),
        ("timestamp", "2020-01-01 10:00:00", dt.datetime(2020, 1, 1, 10)),
        ("timestamp", "noon", None),
        ("string", "  a\t ", "a\t"),
    ],
)
def test_typed(spark, kind, raw, wanted):
    assert one(spark, ty.typed(F.lit(raw).cast("string"), kind)) == wanted


@pytest.mark.parametrize(
    "kind, raw, pattern, wanted",
    [
        ("date", "3/14/2021", "M/d/yyyy", "2021-03-14"),
        ("date", "14-03-2021", "dd-MM-yyyy", "2021-03-14"),
        ("date", "14/14/2021", "M/d/yyyy", ""),
        ("timestamp", "1/2/2021 9:30:00", "M/d/yyyy H:mm[:ss]", "2021-01-02 09:30:00"),
        ("timestamp", "1/2/2021 10:30", "M/d/yyyy H:mm[:ss]", "2021-01-02 10:30:00"),
        ("timestamp", "2020-01-01 10:00:00.75", None, "2020-01-01 10:00:00"),
        ("numeric", "1", None, "1.0000000000"),
        ("integer", "x", None, ""),
    ],
)
def test_norm(spark, kind, raw, pattern, wanted):
    assert one(spark, norm(F.lit(raw), kind, pattern)) == wanted


def test_row_hash(spark):
    import hashlib

    wanted = hashlib.sha256(b"a||").hexdigest()
    assert one(spark, row_hash(F.lit("a"), F.lit(None).cast("string"))) == wanted
    assert one(spark, row_hash()) is None


def test_lenient(spark):
    raws = ["5", "5.9", " 7 ", "x", "", None, "-2.5"]
    found = [one(spark, lenient_int(F.lit(r).cast("string"))) for r in raws]
    assert found == [5, 5, 7, 0, 0, 0, -2]
    assert one(spark, split_list(F.lit(" a, ,b,"))) == ["a", "b"]


def test_mapping_documents():
    columns = [
        {"source_column": "id", "target_column": "no", "data_type": "Numeric"},
        {"source_column": "d", "target_column": "e", "data_type": "date", "date_format": "M/d/yyyy"},
        {"source_column": "lost", "target_column": None},
    ]
    keys = [{"source_column": "id", "target_column": "no"}]
    mapping = Mapping.from_json({"common": {"primary_keys": keys}, "column_mappings": columns})
    assert mapping.key_names == ["id"] and mapping.compare_names == ["d"]
    assert [c.source for c in mapping.gaps] == ["lost"]
    assert mapping.keys[0].spark_type == "decimal(38,10)"
    named = Mapping.from_json({"primary_keys": keys, "column_mappings": columns}, names="target")
    assert named.compare_names == ["e"]
    for bad in (
        {"primary_keys": [], "column_mappings": columns},
        {"primary_keys": keys, "column_mappings": []},
        {"primary_keys": [{"source_column": "id", "target_column": "x"}], "column_mappings": columns},
    ):
        with pytest.raises(MappingError):
            Mapping.from_json(bad)
    with pytest.raises(MappingError, match="date_format"):
        Mapping.of(["a"], [ColumnMap("a", "a"), ColumnMap("d", "d", "date")], require_formats=True)


def test_declared_schema():
    from evenkeel.sources.load import declared_schema

    mapping = Mapping.of(["a"], [ColumnMap("a", "b", "integer"), ColumnMap("d", "e", "date")])
    assert declared_schema(mapping, "target").simpleString() == "struct<b:bigint,e:date>"
