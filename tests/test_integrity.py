"""Foreign keys against plain loops, rules on odd columns, and tables whose partitions stay untouched."""

from pathlib import Path

import pytest
from conftest import values
from pyspark.sql import functions as F
from test_compare_repair import MAPPING, random_pair

from evenkeel import ColumnMap, Mapping
from evenkeel.operators import repair
from evenkeel.operators.integrity import (
    ForeignKey,
    Rule,
    apply_rules,
    orphan_rows,
    orphan_values,
    referential_integrity,
    rules_from,
)
from evenkeel.sources import partitioned as P


def test_foreign_keys_of_one_and_two_columns(spark):
    child = [(i, 7 if i % 3 == 0 else i % 5, None if i % 10 == 0 else "ab"[i % 2]) for i in range(300)] + [(None, None, "a")]
    parent = [(i, c) for i in range(4) for c in "a" if i != 2] + [(1, "b"), (None, "b"), (3, None)]
    tables = {
        "child": spark.createDataFrame(child, "id int, k int, c string"),
        "parent": spark.createDataFrame(parent, "k bigint, c string"),
    }
    keys = [
        ForeignKey("one", "child", ("k",), "parent", ("k",)),
        ForeignKey("two", "child", ("k", "c"), "parent", ("k", "c")),
        ForeignKey("self", "child", ("k",), "child", ("id",)),
    ]

    def plain(name, columns, known):
        checked = [tuple(r[c] for c in columns) for r in child]
        whole = [v for v in checked if None not in v]
        lost = [v for v in whole if v not in known]
        return name, len(whole), len(checked) - len(whole), len(set(lost)), len(lost), "FAIL" if lost else "PASS"

    wanted = [
        plain("one", (1,), {(k,) for k, _ in parent}),
        plain("two", (1, 2), set(parent)),
        plain("self", (1,), {(r[0],) for r in child}),
    ]
    found = referential_integrity(tables, keys).drop("child_table", "parent_table")
    assert sorted(map(tuple, found.collect())) == sorted(wanted)
    lost = {(r.constraint_name, *r.value): r.orphan_rows for r in orphan_values(tables, keys).collect()}
    assert lost["one", "7"] == 100 and all(name != "self" for name, *_ in lost)
    rows = orphan_rows(tables, keys, "two")
    assert rows.columns == ["id", "k", "c"] and rows.count() == wanted[1][4]
    none = {"child": tables["child"].limit(0), "parent": tables["parent"]}
    assert [r.status for r in referential_integrity(none, keys).collect()] == ["PASS"] * 3
    with pytest.raises(ValueError):
        referential_integrity(tables, [ForeignKey("x", "child", ("k", "c"), "parent", ("k",))])


def test_rules(spark):
    rows = [(i, None if i % 4 == 0 else float(i), f"a{i}" if i else "a\n", None) for i in range(20)]
    df = spark.createDataFrame(rows, "n int, v double, `t x` string, e string")
    rules = [
        Rule("share", "t", "v", "not_null", tolerance=0.25), Rule("nulls", "t", "v", "not_null", tolerance=0.2),
        Rule("low", "t", "v", "min", low=2), Rule("high", "t", "v", "max", high=19), Rule("both", "t", "n", "range", low=1, high=18),
        Rule("pattern", "t", "t x", "pattern", pattern="a[0-9]+|b"), Rule("length", "t", "t x", "length", low=2, high=2),
        Rule("set", "t", "n", "in_set", allowed=tuple(range(19))), Rule("sum", "t", "n", "sum", low=190, high=190),
        Rule("avg", "t", "v", "avg", high=9), Rule("none", "t", "e", "avg", low=0), Rule("count", "t", None, "row_count", high=20),
        Rule("gone", "t", "zz", "min", low=1), Rule("away", "u", "v", "min", low=1), Rule("distinct", "t", "n", "approx_distinct", low=19, high=21),
    ]
    found = {r.rule_id: r for r in apply_rules({"t": df}, rules).collect()}
    status = {k: r.status for k, r in found.items()}
    assert [k for k in status if status[k] == "FAIL"] == ["nulls", "low", "both", "pattern", "length", "set", "avg", "none"]
    assert [k for k in status if status[k] == "SKIPPED"] == ["gone", "away"]
    assert [found[k].failed_rows for k in ("share", "low", "high", "both", "pattern", "length", "set")] == [5, 1, 0, 2, 1, 10, 1]
    assert found["sum"].value == 190 and found["count"].value == 20 and found["none"].value is None
    empty = {r.rule_id: r.status for r in apply_rules({"t": df.limit(0)}, rules[:6]).collect()}
    assert set(empty.values()) == {"PASS"}
    with pytest.raises(ValueError):
        Rule("x", "t", "v", "sounds_right")


def test_rules_as_a_table_read_each_table_once(spark, tmp_path):
    df = spark.range(50).withColumn("v", F.col("id") * 2)
    df.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    frame = spark.createDataFrame(
        [(f"r{i}", "t", "v", "range", 0.0, float(90 + i), None) for i in range(20)],
        "rule_id string, table string, column string, kind string, low double, high double, allowed array<string>",
    )
    found = apply_rules({"t": stored}, rules_from(frame))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1
    assert {r.rule_id: r.failed_rows for r in found.collect()} == {f"r{i}": len([x for x in range(50) if 2 * x > 90 + i]) for i in range(20)}


def _files(path):
    return {str(f): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}


def _parts(files):
    return {int(f.split("_part=")[1].split("/")[0]) for f in files}


def test_upsert_leaves_other_partitions_alone(spark, tmp_path):
    old = spark.range(500).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    path = P.write_keyed(old, str(tmp_path / "t"), ["k"], parts=16)
    before = _files(path)
    new = spark.createDataFrame([("new", 3), ("newer", 3), ("new", 4), ("new", 10_000)], "v string, k long")
    touched = P.upsert_stored(path, new, ["k"], parts=16)
    after = _files(path)
    assert 0 < len(touched) <= 3
    kept = {f: t for f, t in before.items() if _parts([f]) - set(touched)}
    assert kept == {f: t for f, t in after.items() if _parts([f]) - set(touched)} and _parts(after) == set(range(16))
    assert values(P.read_keyed(spark, path)) == values(repair.upsert_by_key(old, new.select("k", "v"), ["k"]))
    assert P.upsert_stored(path, new.limit(0), ["k"], parts=16) == [] and _files(path) == after


def test_repair_leaves_equal_partitions_alone(spark, tmp_path):
    mapping = Mapping.of(["k"], [ColumnMap("k", "k", "numeric"), ColumnMap("v", "v")])
    source = spark.range(300).select(F.col("id").cast("string").alias("k"), F.lit("x").alias("v"))
    target = source.select(F.concat("k", F.lit(".0")).alias("k"), F.when(F.col("k") == "7", "y").otherwise(" x ").alias("v"))
    path = P.write_target(target, str(tmp_path / "t"), mapping, parts=16)
    before = _files(path)
    assert len(touched := P.repair_stored(path, source, mapping, parts=16)) == 1
    after = _files(path)
    assert {f for f in before if _parts([f]) != set(touched)} == {f for f in after if _parts([f]) != set(touched)}
    assert P.read_keyed(spark, path).filter("trim(v) <> 'x'").count() == 0
    assert P.repair_stored(path, source, mapping, parts=16) == []
    # Partitions that lose all their rows go.
    few = source.filter("k in ('1', '2')")
    P.repair_stored(path, few, mapping, parts=16)
    assert values(P.read_keyed(spark, path)) == [("1.0", " x "), ("2.0", " x ")] and len(_parts(_files(path))) <= 2


@pytest.mark.parametrize("seed", [1, 2])
def test_stored_repair_equals_the_repair(text, tmp_path, seed):
    source, target = random_pair(text, seed)
    path = P.write_target(target, str(tmp_path / "t"), MAPPING, parts=4)
    P.repair_stored(path, source, MAPPING, parts=4)
    plan = repair.plan_repair(target, source, MAPPING)
    assert values(P.read_keyed(target.sparkSession, path)) == values(repair.repaired(plan))


def test_rows_that_share_one_lost_value_stay_where_they_are(spark, tmp_path):
    """Few values without a parent are broadcast: the child rows are neither shuffled nor sorted."""
    spark.range(3000).selectExpr("id", "case when id % 3 = 0 then -1 when id % 7 = 0 then null else id % 50 end k").write.parquet(str(tmp_path / "child"))
    spark.range(50).selectExpr("id k").write.parquet(str(tmp_path / "parent"))
    tables = {t: spark.read.parquet(str(tmp_path / t)) for t in ("child", "parent")}
    found = orphan_rows(tables, [ForeignKey("c", "child", ("k",), "parent", ("k",))], "c")
    assert sorted(r.id for r in found.collect()) == list(range(0, 3000, 3))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
