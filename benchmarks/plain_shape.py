"""The same results by the straightforward plan: a join per question and a pass per column.

python benchmarks/plain_shape.py prints seconds of both plans. The straightforward one removes
duplicates of each side for every question, joins the sides three times (twice anti, once inner),
filters hashes first and then once per column, counts cast failures once per column, and repairs
by three steps with a join each.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from functools import reduce  # noqa: E402

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from evenkeel.functions.normalize import row_hash  # noqa: E402
from evenkeel.functions.typed import cast_fails  # noqa: E402
from evenkeel.operators import layout  # noqa: E402
from evenkeel.queries import registered  # noqa: E402
from evenkeel.queries.inputs import LINES, MAPPING, pair, table  # noqa: E402
from evenkeel.session import build  # noqa: E402

KEY = "norm_order_id"


def sides(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    source, target = pair(spark, sf_dir)
    target = layout.rename_to_common(target, MAPPING, "target")
    # Normalized columns under the common names on both sides.
    same = MAPPING.__class__(
        *(tuple(c.__class__(c.source, c.source, c.data_type) for c in part)
          for part in (MAPPING.keys, MAPPING.compare))
    )
    return layout.with_norm(source, same, "source"), layout.with_norm(target, same, "target")


def classify_rows(spark, sf_dir):
    s, t = (df.dropDuplicates([KEY]).select("order_id", KEY) for df in sides(spark, sf_dir))
    found = [
        s.join(t.select(KEY), KEY, "left_anti").select(KEY, F.lit("source_only").alias("state")),
        t.join(s.select(KEY), KEY, "left_anti").select(KEY, F.lit("target_only").alias("state")),
        s.select(KEY).join(t.select(KEY), KEY).select(KEY, F.lit("matched").alias("state")),
    ]
    return reduce(DataFrame.unionByName, found)


def mismatch_long(spark, sf_dir):
    norms = [f"norm_{c}" for c in MAPPING.compare_names]
    s, t = (
        df.dropDuplicates([KEY]).withColumn("h", row_hash(*[F.col(n) for n in norms]))
        for df in sides(spark, sf_dir)
    )
    joined = s.alias("s").join(t.alias("t"), KEY).filter("s.h <> t.h")
    parts = [
        joined.filter(F.col(f"s.norm_{c}") != F.col(f"t.norm_{c}")).select(
            "s.order_id",
            F.lit(c).alias("column_name"),
            F.col(f"s.{c}").alias("source_value"),
            F.col(f"t.{c}").alias("target_value"),
        )
        for c in MAPPING.compare_names
    ]
    return reduce(DataFrame.unionByName, parts)


def cast_failures(spark, sf_dir):
    parts = []
    for side, df in zip(("source", "target"), pair(spark, sf_dir)):
        for c in MAPPING.columns:
            bad = df.filter(cast_fails(F.col(c.on(side)), c.kind))
            parts.append(
                bad.agg(F.count(F.lit(1)).alias("n")).select(
                    F.lit(side).alias("dataset_name"), F.lit(c.source).alias("column_name"), "n"
                )
            )
    return reduce(DataFrame.unionByName, parts)


def dedupe_by_key(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select(*[c.source for c in LINES.columns])
    return df.dropDuplicates(LINES.key_names)


def recon_apply(spark, sf_dir):
    s, t = sides(spark, sf_dir)
    s = s.dropDuplicates([KEY])
    wrong = mismatch_long(spark, sf_dir).select("order_id").distinct()
    right = s.join(wrong, "order_id", "left_semi").select(
        KEY, *[F.col(c).alias(f"new_{c}") for c in MAPPING.compare_names]
    )
    fixed = t.join(right, KEY, "left").select(
        KEY,
        "order_id",
        *[F.coalesce(f"new_{c}", c).alias(c) for c in MAPPING.compare_names],
    )
    only_source = s.join(t.select(KEY).distinct(), KEY, "left_anti")
    only_target = t.select(KEY).distinct().join(s.select(KEY), KEY, "left_anti")
    grown = fixed.unionByName(only_source.select(fixed.columns))
    return grown.join(only_target, KEY, "left_anti").drop(KEY)


PLAIN = {f.__name__: f for f in (classify_rows, mismatch_long, cast_failures, dedupe_by_key, recon_apply)}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build(
        "plain",
        {
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name, plain in PLAIN.items():
        seconds = {}
        for label, query in (("plain", plain), ("ours", registered()[name][0])):
            times = []
            for _ in range(4):
                start = time.perf_counter()
                query(spark, sf_dir).write.format("noop").mode("overwrite").save()
                times.append(time.perf_counter() - start)
            seconds[label] = round(statistics.median(times[1:]), 2)
        print(json.dumps({"query": name, **seconds}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
