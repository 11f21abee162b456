"""Every registered query against its SQL counterpart on the smallest test tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare, duck
from lumenframe.plans import catalogue

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = queries(), oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, con, name):
    got = QUERIES[name](spark, FOLDER).toPandas()
    spark.catalog.clearCache()
    if name in ORACLES:
        verdict = compare(got, con.execute(ORACLES[name]).fetchdf())
        assert verdict.startswith("ok"), verdict
    assert len(got.columns) > 0


def test_entry(spark):
    df = entry(spark)
    assert {"grp", "arm", "pix", "flux", "ivar", "snr"} <= set(df.columns)


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
    assert len(catalogue.QUERIES) - len(catalogue.ORACLES) <= 3
