"""The whole chain on stored tables."""

from conftest import values
from pyspark.sql import functions as F

from evenkeel.plans.generate import generate_mapping, to_mapping
from evenkeel.plans.jobs import closure_job, read_history, reconcile_job, validate_job
from evenkeel.sources.load import load
from evenkeel.sources.save import save


def test_chain(spark, tmp_path):
    base = str(tmp_path)
    source = spark.range(50).select(
        F.col("id").cast("string").alias("cust_id"),
        (F.col("id") * 10).cast("string").alias("salary_amt"),
        F.lit("2020-01-02").alias("join_date"),
    )
    target = source.filter("cust_id <> '7'").select(
        F.col("cust_id").alias("CUSTID"),
        F.when(F.col("cust_id") == "9", "1").otherwise(F.col("salary_amt")).alias("salary"),
        F.col("join_date").alias("JoinDate"),
    )
    target = target.unionByName(spark.sql("select '99' CUSTID, '1' salary, '2020-01-02' JoinDate"))
    one = save(source, f"{base}/source.csv", "csv")
    two = save(target, f"{base}/target.json", "json")

    rows = generate_mapping(load(spark, one), load(spark, two), {"salary_amt": "salary"})
    assert values(rows.select("source_column", "target_column", "match_type", "data_type")) == [
        ("cust_id", "CUSTID", "one-to-one", "integer"),
        ("join_date", "JoinDate", "one-to-one", "date"),
        ("salary_amt", "salary", "override", "integer"),
    ]
    mapping = to_mapping(rows, ["cust_id"], require_formats=True)

    history = f"{base}/history.parquet"
    common = {"out": f"{base}/reports", "history": history, "pipeline": "customers"}
    assert validate_job(spark, one, two, mapping, run_id="1", **common) == "FAIL"
    fixed = reconcile_job(spark, one, two, mapping, run_id="2", **common)
    assert fixed.endswith("target.json")
    status = validate_job(spark, one, fixed, mapping, run_id="3", stage="revalidation", **common)
    assert status == "PASS"
    runs = {r.stage: r for r in read_history(spark, history).collect()}
    assert (runs["validation"].total_mismatch, runs["revalidation"].total_mismatch) == (1, 0)
    assert (runs["reconciliation"].total_inserts, runs["reconciliation"].total_deletes) == (1, 1)

    paths = closure_job(spark, history, f"{base}/closure")
    business = [tuple(r)[2:] for r in spark.read.parquet(paths["business_summary"]).collect()]
    assert business == [
        ("Δ 0", "Inserted 1 missing rows", "Δ 0", "None"),
        ("1 mismatches", "1 rows updated", "0 mismatches", "None"),
        ("PASS", "N/A", "PASS", "None"),
        ("1", "1 rows deleted", "0", "None"),
    ]
    details = spark.read.parquet(f"{base}/reports/run_id=1/detailed_mismatch")
    assert values(details) == [("9", "salary_amt", "90", "1")]
