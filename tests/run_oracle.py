"""Check registered queries at a scale: python tests/run_oracle.py [sf_dir] [name ...]"""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parent.parent), str(Path(__file__).resolve().parent)]

from oracle import connect, differences  # noqa: E402

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from evenkeel.session import build  # noqa: E402

sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
spark = build(
    "oracle",
    {"spark.master": "local[8]", "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"},
)
spark.sparkContext.setLogLevel("ERROR")
con, sql, bad = connect(sf_dir), oracle_sql(), 0
for name, query in queries().items():
    if len(sys.argv) > 2 and name not in sys.argv[2:]:
        continue
    start = time.time()
    try:
        df = query(spark, sf_dir)
        notes = differences(df, con, sql[name]) if name in sql else [] if df.count() else ["empty"]
    except Exception as error:
        notes = [f"{type(error).__name__}: {str(error)[:600]}"]
        if len(sys.argv) > 2:
            traceback.print_exc()
    bad += bool(notes)
    mark = "BAD " if notes else "ok  " if name in sql else "rows"
    print(f"{mark} {name} {time.time() - start:.1f}s", *notes, sep="\n     " if notes else " ", flush=True)
print(f"{bad} bad")
