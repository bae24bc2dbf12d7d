"""What the writing pass counts equals what separate checks count, and inputs are read once."""

import pytest
from conftest import values
from pyspark.sql import functions as F
from test_compare_repair import MAPPING, random_pair

from evenkeel.operators import checks, repair
from evenkeel.plans.observed import save_observed, save_repair, save_validation
from evenkeel.plans.validation import Validation


def metered(df):
    """The same rows, and an accumulator of how many were read."""
    seen = df.sparkSession.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(count, df.schema), seen


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("null_keys", ["equal", "distinct"])
def test_saved_validation_equals_the_checks(text, tmp_path, seed, null_keys):
    source, target = random_pair(text, seed)
    (left, a), (right, b) = metered(source), metered(target)
    saved = save_validation(left, right, MAPPING, str(tmp_path / "run"), null_keys=null_keys)
    assert (a.value, b.value) == (60, 60)  # both tables once, with all details written
    run = Validation(source, target, MAPPING, null_keys=null_keys)
    shown = run.summary.columns
    assert values(saved.summary.select(shown)) == values(run.summary)
    assert values(saved.checks) == values(run.checks)
    row = saved.summary.first()
    assert row.source_partition_count > 0 and row.run_seconds > 0 and row.run_timestamp and row.partition_count_status == "INFO"
    for name, df in run.details().items():
        if name != "schema_datatype_drift":
            stored = source.sparkSession.read.parquet(row[f"{name}_location"])
            assert values(stored.select(df.columns)) == values(df), name


def test_saved_validation_of_empty_and_lacking_tables(text, tmp_path):
    source, target = random_pair(text, 3)
    saved = save_validation(source.limit(0), target.limit(0), MAPPING, str(tmp_path / "none"), details=False)
    assert saved.summary.first().overall_status == "PASS" and saved.summary.first().source_count == 0
    lacking = target.drop("amt")
    saved = save_validation(source, lacking, MAPPING, str(tmp_path / "some"), strict=False)
    run = Validation(source, lacking, MAPPING, strict=False)
    assert values(saved.summary.select(run.summary.columns)) == values(run.summary)


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_saved_repair_counts_its_rows(text, tmp_path, fmt):
    source, target = random_pair(text, 4)
    plan = repair.plan_repair(target, source, MAPPING)
    metered_plan, seen = metered(plan)
    saved = save_repair(metered_plan, str(tmp_path / "t"), fmt)
    assert seen.value == plan.count()
    fixed = repair.repaired(plan)
    assert values(saved.summary) == values(repair.repair_summary(plan))
    assert values(saved.null_counts) == values(checks.null_counts(fixed))
    if fmt == "parquet":
        assert values(target.sparkSession.read.parquet(str(tmp_path / "t"))) == values(fixed)


def test_counters_of_a_write(spark, tmp_path):
    df = spark.range(10)
    found = save_observed(df, str(tmp_path / "x"), {"n": F.count(F.lit(1)), "odd": F.count_if(F.col("id") % 2 == 1)})
    assert found == {"n": 10, "odd": 5} and spark.read.parquet(str(tmp_path / "x")).count() == 10
