"""Every registered query against its SQL on the smallest tables (a few slow ones on demand)."""

import os

import pytest

duckdb = pytest.importorskip("duckdb")

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")

import __spark_entry__ as entry  # noqa: E402
from check_oracle import compare  # noqa: E402
from scanloom.plans.registry import ORACLE, QUERIES, TABLES  # noqa: E402


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    text, _, good = compare(spark, con, SF, name, QUERIES[name], ORACLE.get(name))
    assert good, text


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())
