"""Comparison by digests equals comparison by value; duplicated keys pair copy by copy."""

from collections import Counter

import pytest
from conftest import values
from pyspark.sql import functions as F
from test_compare_repair import MAPPING, random_pair

from evenkeel import ColumnMap, Mapping
from evenkeel.operators import digest
from evenkeel.operators.classify import classify, slim
from evenkeel.plans.validation import Validation


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("null_keys", ["equal", "distinct"])
def test_digest_comparison_equals_comparison_by_value(text, seed, null_keys):
    source, target = random_pair(text, seed)
    found = digest.classify_by_digest(source, target, MAPPING, levels=(2, 5), null_keys=null_keys)
    wanted = slim(classify(source, target, MAPPING, null_keys))
    assert values(found.select(wanted.columns)) == values(wanted)


def test_unique_keys_and_empty_tables(text):
    rows = [(str(i), str(i), "1/2/2020", "x") for i in range(300)]
    source = text("id amount day name", rows)
    changed = [(r[0] + ".0", r[1], "01/02/2020", "y" if r[0] == "7" else " x ") for r in rows if r[0] != "9"]
    target = text("no amt dt nm", [*changed, ("1000", "1", None, None)])
    for left, right in ((source, target), (source.limit(0), target), (source, target.limit(0)), (source.limit(0), target.limit(0))):
        found = digest.classify_by_digest(left, right, MAPPING)
        assert values(found) == values(slim(classify(left, right, MAPPING)).select(found.columns))
    own = Validation(source, target, MAPPING, digest_levels=(4, 8))
    assert values(own.checks) == values(Validation(source, target, MAPPING).checks)
    assert [r.column_name for r in own.mismatch_long.collect()] == ["name"]


def test_values_of_equal_buckets_stay(spark):
    """Three rows of 20,000 differ: a few rows meet by value, the others never leave their task."""
    mapping = Mapping.of(["k"], [ColumnMap("k", "k", "integer"), ColumnMap("v", "v")])
    source = spark.range(20_000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("v"))
    target = source.withColumn("v", F.when(F.col("k").isin(5, 6, 77), "other").otherwise(F.col("v")))
    coarse, fine = digest.differing(source, target, mapping, levels=(8, 16))
    assert coarse.count() <= 3 and fine.count() == 3
    assert fine.agg(F.sum("source_rows")).first()[0] < 20 < coarse.agg(F.sum("source_rows")).first()[0] < 400
    assert digest.classify_by_digest(source, target, mapping).filter("state = 'mismatch'").count() == 3


@pytest.mark.parametrize("levels", [(), (8, 8), (9, 3), (64,), (0, 4)])
def test_levels_must_rise(text, levels):
    source, target = random_pair(text, 1)
    with pytest.raises(ValueError):
        digest.classify_by_digest(source, target, MAPPING, levels=levels)


def test_bags_pair_copy_by_copy(spark):
    """A third of all rows under one key, copies of unequal numbers, NULLs: as multisets say."""
    mapping = Mapping.of(["k"], [ColumnMap("k", "k", "integer"), ColumnMap("v", "w"), ColumnMap("n", "n", "numeric")])
    left = [(0 if i % 3 == 0 else i % 7, f"v{i % 5}", str(i % 4)) for i in range(900)] + [(None, None, None)] * 3
    right = [(0 if i % 3 == 0 else i % 7, f" v{i % 5} ", f"{i % 4}.0") for i in range(870)] + [(None, None, None), (5, "new", "1")]
    source, target = spark.createDataFrame(left, "k int, v string, n string"), spark.createDataFrame(right, "k int, w string, n string")

    def norm(k, v, n):
        return ("" if k is None else str(k), (v or "").strip(), "" if n is None else f"{float(n):.10f}")

    a, b = Counter(norm(*r) for r in left), Counter(norm(*r) for r in right)
    wanted = [(*r, "source", c) for r in a for c in range(b[r] + 1, a[r] + 1)] + [(*r, "target", c) for r in b for c in range(a[r] + 1, b[r] + 1)]
    found = digest.bag_differences(source, target, mapping)
    assert found.columns == ["k", "v", "n", "side", "copy"]
    assert sorted(map(tuple, found.collect())) == sorted(wanted)
    totals = digest.bag_summary(source, target, mapping).first()
    assert tuple(totals) == (903, 872, sum((a & b).values()), sum((a - b).values()), sum((b - a).values()))
    assert digest.bag_differences(source.limit(0), target.limit(0), mapping).count() == 0
    assert tuple(digest.bag_summary(source.limit(0), target.limit(0), mapping).first()) == (0, 0, 0, 0, 0)


def test_rows_of_paired_digests_stay(spark, monkeypatch):
    """Half of the rows are left over: hardly any other meets the exact join, and a full bitmap changes no result."""
    mapping = Mapping.of(["k"], [ColumnMap("k", "k", "integer"), ColumnMap("v", "v")])
    source = spark.range(4000).select((F.col("id") % 50).alias("k"), F.col("id").cast("string").alias("v"))
    target = source.withColumn("v", F.when(F.col("v").cast("int") % 2 == 0, F.concat(F.lit("x"), "v")).otherwise(F.col("v")))
    rows = digest._tagged(source, mapping, "source", "equal")
    wanted = rows.filter("cast(_v0 as int) % 2 = 0").select("d1", "d2")
    kept = [r._v0 for r in digest._sifted(rows, wanted).collect()]
    assert len(kept) == len(set(kept)) and {str(i) for i in range(0, 4000, 2)} <= set(kept) and len(kept) < 2050
    assert digest._sifted(rows, wanted.limit(0)).count() == 0
    monkeypatch.setattr(digest, "SIFTED", 1 << 10)  # a full bitmap rules nothing out
    assert digest._sifted(rows, wanted).count() > 3000
    found = digest.bag_differences(source, target, mapping)
    wanted = [(str(i % 50), f"{'x' * side}{i}", ("source", "target")[side], 1) for i in range(0, 4000, 2) for side in (0, 1)]
    assert sorted((r.k, r.v, r.side, r.copy) for r in found.collect()) == sorted(wanted)
