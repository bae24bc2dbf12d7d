"""Keys that do not fit their declared kind stay apart, in comparison and repair."""

from evenkeel import Mapping
from evenkeel.mapping import ColumnMap, MappingError
from evenkeel.operators.digest import bag_summary
from evenkeel.plans.reconcile import reconcile
from evenkeel.plans.validation import Validation

import pytest


def test_every_source_key_is_in_the_repaired_target(spark):
    source = spark.createDataFrame(
        [("9" * 30, "a"), ("AB1", "b"), ("AB2", "c"), ("7", "d"), (" AB3 ", "e")], "id string, v string"
    )
    target = spark.createDataFrame(
        [("8" * 30, "x"), ("7.0", "d"), ("AB2", "z"), ("AB3", "e")], "key string, w string"
    )
    mapping = Mapping.of(["id"], [ColumnMap("id", "key", "numeric"), ColumnMap("v", "w", "string")])
    done = reconcile(source, target, mapping)
    rows = {r.key.strip(): r.w for r in done.repaired.collect()}
    assert rows == {"9" * 30: "a", "AB1": "b", "AB2": "c", "7.0": "d", "AB3": "e"}
    assert tuple(done.summary.first())[2:6] == (1, 1, 2, 1)


def test_large_doubles_declared_integer(spark):
    source = spark.createDataFrame([(1, 2e7), (2, 3e9)], "id int, v double")
    target = spark.createDataFrame([(1, 9.9e7), (2, 3e9)], "id int, v double")
    mapping = Mapping.of(["id"], [ColumnMap("id", "id", "integer"), ColumnMap("v", "v", "integer")])
    assert reconcile(source, target, mapping).summary.first().total_updates == 1


def test_a_source_column_has_one_target():
    with pytest.raises(MappingError):
        Mapping.of(["a"], [ColumnMap("a", "b", "string"), ColumnMap("a", "c", "string")])


@pytest.mark.parametrize("levels", [None, (2, 4)])
def test_values_that_do_not_fit_can_count_as_different(spark, levels):
    source = spark.createDataFrame([(1, "n/a"), (2, "n/a"), (3, None), (4, "5"), (5, " x ")], "id int, v string")
    target = spark.createDataFrame([(1, "abc"), (2, ""), (3, " "), (4, "5.0"), (5, "x")], "id int, v string")
    columns = [ColumnMap("id", "id", "integer"), ColumnMap("v", "v", "numeric")]
    loose, strict = Mapping.of(["id"], columns), Mapping.of(["id"], columns, unfit="distinct")
    for mapping, wanted in ((loose, []), (strict, [1, 2])):
        run = Validation(source, target, mapping, digest_levels=levels)
        assert sorted(r.id for r in run.mismatch_long.collect()) == wanted
        assert sorted(r.id for r in run.mismatch_wide.collect()) == wanted
        assert run.summary.first().mismatch_record_count == len(wanted)
        assert reconcile(source, target, mapping).summary.first().total_updates == len(wanted)
    assert bag_summary(source, target, strict).first().source_leftovers == 2
    assert bag_summary(source, target, loose).first().source_leftovers == 0
    with pytest.raises(MappingError):
        Mapping.of(["id"], columns, unfit="maybe")


def test_typed_drift_tells_what_the_cast_gives(spark):
    source = spark.sql("select 1 id, true flag, timestamp_ntz'2020-01-01 10:00:00' at")
    target = spark.sql("select 1 id, 'yes' flag, '2020-01-01 10:00:00' at")
    columns = [ColumnMap("id", "id", "integer"), ColumnMap("flag", "flag", "boolean"), ColumnMap("at", "at", "timestamp")]
    rows = Validation(source, target, Mapping.of(["id"], columns)).schema_drift.collect()
    assert {(r.column_name, r.source_data_type, r.drift_type) for r in rows} == {
        ("id", "bigint", "NO_DRIFT"), ("flag", "boolean", "NO_DRIFT"), ("at", "timestamp", "NO_DRIFT"),
    }
