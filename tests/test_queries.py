"""Every registered query against its SQL, on the smallest given tables."""

import os

import pytest
from oracle import connect, differences

from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, con, name):
    found = queries()[name](spark, SF_DIR)
    sql = oracle_sql().get(name)
    if sql is None:
        assert found.count() > 0
    else:
        assert differences(found, con, sql) == []


def test_known_counts(spark):
    states = {
        r.state: r["count"]
        for r in queries()["classify_rows"](spark, SF_DIR).groupBy("state").count().collect()
    }
    if SF_DIR.endswith("sf0.001"):
        assert states["source_only"] == 16 and states["target_only"] == 15
        assert states["mismatch"] == 58 and states["mismatch"] + states["equal"] == 1484
        assert entry(spark).count() == 69
