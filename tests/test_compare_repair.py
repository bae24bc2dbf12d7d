"""Properties of comparison and repair, and the odd values they must survive."""

import random

import pytest
from conftest import values
from pyspark.sql import functions as F

from evenkeel import ColumnMap, Mapping
from evenkeel.operators import checks, compare, repair
from evenkeel.operators.classify import classify, paired
from evenkeel.plans.reconcile import reconcile
from evenkeel.plans.validation import Validation

MAPPING = Mapping.of(
    ["id"],
    [
        ColumnMap("id", "no", "numeric"),
        ColumnMap("amount", "amt", "numeric"),
        ColumnMap("day", "dt", "date", "d/M/yyyy"),
        ColumnMap("name", "nm"),
    ],
)


def random_pair(text, seed, rows=60):
    rng = random.Random(seed)
    amounts = ["1", "1.0", "2", "n/a", "", None, "-3", "1e3", "0", "0.00"]
    days = ["1/2/2020", "01/02/2020", "3/4/2021", "31/2/2020", None, " "]
    names = ["a", " a ", "a||b", "b", None, "", "\ta"]
    keys = [str(i) for i in range(12)] + ["1.0", "2.00", "", None, " ", "x"]

    def make():
        return [
            (rng.choice(keys), rng.choice(amounts), rng.choice(days), rng.choice(names))
            for _ in range(rows)
        ]

    return text("id amount day name", make()), text("no amt dt nm", make())


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("null_keys", ["equal", "distinct"])
def test_one_pass_repair_equals_the_three_steps(text, seed, null_keys):
    source, target = random_pair(text, seed)
    plan = repair.plan_repair(target, source, MAPPING, null_keys=null_keys)
    step = repair.update_rows(target, source, MAPPING, null_keys=null_keys)
    if null_keys == "equal":
        step = repair.insert_rows(step, source, MAPPING)
        step = repair.delete_rows(step, source, MAPPING)
    else:  # rows without a partner would be deleted again after their insertion
        step = repair.delete_rows(step, source, MAPPING, null_keys)
        step = repair.insert_rows(step, source, MAPPING, null_keys)
    assert values(repair.repaired(plan)) == values(step)


@pytest.mark.parametrize("seed", [3, 4])
def test_repair_leaves_nothing_to_repair(text, seed):
    source, target = random_pair(text, seed)
    plan = repair.plan_repair(target, source, MAPPING, null_update="overwrite")
    fixed = repair.repaired(plan)
    run = Validation(source, fixed, MAPPING)
    totals = checks.key_totals(run.classified).first()
    assert totals.mismatch_record_count == 0
    assert totals.extra_records_in_source_count == totals.extra_records_in_target_count == 0
    again = repair.repaired(
        repair.plan_repair(fixed, source, MAPPING, null_update="overwrite")
    )
    assert values(again) == values(fixed)


@pytest.fixture
def splitting(spark):
    """Settings under which small skewed partitions are split and no side is broadcast."""
    wanted = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _final(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_target_rows_all_survive(spark, splitting):
    """One key holds most target rows; each copy is repaired, none is lost, and its partition is split."""
    target = spark.range(0, 30_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.lit(1)).cast("string").alias("no"),
        F.lit("5").alias("amt"),
        F.lit("1/2/2020").alias("dt"),
        F.sha2(F.col("id").cast("string"), 256).alias("nm"),
    )
    source = spark.range(15_000).select(
        F.col("id").cast("string").alias("id"),
        F.lit("6").alias("amount"),
        F.lit("1/2/2020").alias("day"),
        F.lit("z").alias("name"),
    )
    plan = repair.plan_repair(target, source, MAPPING)
    totals = repair.repair_summary(plan).first()
    assert (totals.total_updates, totals.total_inserts, totals.total_deletes) == (25_000, 9_999, 5_000)
    fixed = repair.repaired(plan)
    assert fixed.filter("amt = 6 and nm = 'z'").count() == 34_999 == fixed.count()
    assert "skew=true" in _final(plan.select("*").agg(F.max("nm"), F.max("_changed")))
    kept = compare.duplicate_rows(target, MAPPING, "target")
    assert kept.count() == 20_000 and "skew=true" in _final(kept.agg(F.max("name")))


def test_order_of_rows_does_not_matter(text):
    source, target = random_pair(text, 5)
    once = values(classify(source, target, MAPPING))
    mixed = classify(source.orderBy(F.desc("name")), target.repartition(7), MAPPING)
    assert values(mixed) == once


def test_states_add_up(text):
    source, target = random_pair(text, 6)
    found = classify(source, target, MAPPING)
    states = {r.state: r["count"] for r in found.groupBy("state").count().collect()}
    totals = checks.key_totals(found).first()
    assert totals.source_row_count == source.count()
    assert totals.target_row_count == target.count()
    assert totals.matched_key_count == states.get("equal", 0) + states.get("mismatch", 0)
    assert values(compare.extra_in_source(found, MAPPING)) == values(
        compare.extra_in_source(compare.key_presence(source, target, MAPPING), MAPPING)
    )


def test_blank_keys_meet_and_null_keys_can_be_kept_apart(text):
    source = text("id amount day name", [(None, "1", None, "a"), ("1", "1", None, "a")])
    target = text("no amt dt nm", [("", "1", None, "a"), (None, "1", None, "a"), ("1.0", "1", None, "a")])
    equal = classify(source, target, MAPPING)
    assert values(equal.select("n_src", "n_tgt", "state")) == [(1, 1, "equal"), (1, 2, "equal")]
    apart = classify(source, target, MAPPING, null_keys="distinct")
    assert values(apart.select("n_src", "n_tgt", "state")) == [
        (0, 1, "target_only"),
        (0, 1, "target_only"),
        (1, 0, "source_only"),
        (1, 1, "equal"),
    ]


def test_separator_in_values_is_still_a_difference(text):
    mapping = Mapping.of(["k"], [ColumnMap("k", "k"), ColumnMap("a", "a"), ColumnMap("b", "b")])
    source = text("k a b", [("1", "a||b", "c")])
    target = text("k a b", [("1", "a", "b||c")])
    pairs = paired(source, target, mapping)
    assert compare.hash_mismatch_rows(pairs, mapping).count() == 0
    assert compare.mismatch_long(pairs, mapping).count() == 2


def test_null_updates(text):
    source = text("id amount day name", [("1", None, None, "b")])
    target = text("no amt dt nm", [("1", "5", None, "a")])
    keep = repair.update_rows(target, source, MAPPING)
    assert values(keep) == [("1", "5", None, "b")]
    over = repair.update_rows(target, source, MAPPING, null_update="overwrite")
    assert values(over) == [("1", None, None, "b")]


def test_union_scope_rewrites_equal_values_too(text):
    source = text("id amount day name", [("1", "1.0", None, "b"), ("2", "2", None, "a")])
    target = text("no amt dt nm", [("1", "1", None, "a"), ("2", "3", None, "a")])
    row = repair.update_rows(target, source, MAPPING)
    assert values(row) == [("1", "1", None, "b"), ("2", "2", None, "a")]
    union = repair.update_rows(target, source, MAPPING, scope="union")
    assert values(union) == [("1", "1.0", None, "b"), ("2", "2", None, "a")]


def test_typed_target_gets_typed_values(spark, text):
    source = text("id amount day name", [("1", "7.5", "3/4/2021", "a"), ("2", "x", "1/1/2021", "n")])
    target = spark.sql(
        "select 1 no, 2.5 amt, date'2020-01-01' dt, 'a' nm, map('k', 1) extra"
    )
    fixed = repair.repaired(repair.plan_repair(target, source, MAPPING))
    assert fixed.schema == target.schema or [f.dataType for f in fixed.schema] == [
        f.dataType for f in target.schema
    ]
    rows = {r.no: (str(r.amt), str(r.dt), r.nm, r.extra) for r in fixed.collect()}
    assert rows == {1: ("7.5", "2021-04-03", "a", {"k": 1}), 2: ("None", "2021-01-01", "n", None)}


def test_empty_sides(text):
    source, target = random_pair(text, 7, rows=5)
    none = source.limit(0)
    assert values(Validation(none, target, MAPPING).mismatch_long) == []
    fixed = repair.repaired(repair.plan_repair(target, none, MAPPING))
    assert fixed.count() == 0
    filled = repair.repaired(repair.plan_repair(target.limit(0), source, MAPPING))
    assert filled.count() == compare.distinct_keys(source, MAPPING, "source").count()
    summary = Validation(none, target.limit(0), MAPPING).summary.first()
    assert (summary.source_count, summary.overall_status) == (0, "PASS")


def test_nested_columns_compare_as_json(spark):
    mapping = Mapping.of(["k"], [ColumnMap("k", "k"), ColumnMap("m", "m")])
    source = spark.sql("select 1 k, map('a', 1) m union all select 2, map('a', 2)")
    target = spark.sql("select 1 k, map('a', 1) m union all select 2, map('a', 3)")
    found = compare.mismatch_long(paired(source, target, mapping), mapping)
    assert values(found) == [(2, "m", '{"a":2}', '{"a":3}')]
    fixed = repair.repaired(repair.plan_repair(target, source, mapping))
    assert {r.k: r.m for r in fixed.collect()} == {1: {"a": 1}, 2: {"a": 2}}


def test_upsert(spark):
    old = spark.sql("select * from values (1, 'a'), (2, 'b') t(k, v)")
    new = spark.sql("select * from values (2, 'z'), (2, 'c'), (3, 'd') t(k, v)")
    done = repair.upsert_by_key(old, new, ["k"])
    assert values(done) == [(1, "a"), (2, "c"), (3, "d")]
    old = spark.sql("select * from values (1, 'a'), (null, 'b') t(k, v)")
    new = spark.sql("select * from values (cast(null as int), 'c') t(k, v)")
    assert values(repair.upsert_by_key(old, new, ["k"])) == [(None, "c"), (1, "a")]


def test_options_reach_the_repair(text):
    source = text("id amount day name", [(None, "1", None, "a"), ("1", "1", None, "b")])
    target = text("no amt dt nm", [(None, "2", None, "z"), ("1", "3", None, "b")])
    done = reconcile(source, target, MAPPING, null_keys="distinct")
    actions = {(r._action, r.amt) for r in done.plan.collect()}
    assert actions == {("insert", "1"), ("delete", "2"), ("update", "1")}
    done = reconcile(source, target.drop("dt"), MAPPING, strict=False)
    assert values(done.repaired) == [(None, "1", "a"), ("1", "1", "b")]
    assert done.after.extra_in_source.count() == 0


def test_missing_columns_are_refused(text):
    source, target = random_pair(text, 8, rows=3)
    with pytest.raises(ValueError, match="source lacks"):
        Validation(source.drop("name"), target, MAPPING)
    run = Validation(source.drop("name"), target, MAPPING, strict=False)
    assert run.missing == {"source": ["name"], "target": []}
    drift = {r.column_name: r.drift_type for r in run.schema_drift.collect()}
    assert drift["name"] == "MISSING_TYPED_COLUMN_IN_SOURCE"
    skipped = [r for r in run.source_cast_failures.collect() if r.status == "SKIPPED"]
    assert [r.column_name for r in skipped] == ["name"]


def test_partition_rows_are_informational(text):
    source, target = random_pair(text, 9)
    run = Validation(source, target, MAPPING, partition_by=("name", "nm"))
    status = {r.validation_name: r.status for r in run.checks.collect()}
    assert status["partition_count_validation"] == "INFO"
