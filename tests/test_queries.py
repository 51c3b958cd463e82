"""Every registered query against its SQL on the smallest tables (TEST_SF_DIR for others)."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tallyloom.workloads import catalog
from tools.check_queries import compare, duck

ORACLES = oracle_sql()
#: The training-data queries have their own tests.
NAMES = list(catalog())


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_entry(spark):
    df = entry(spark)
    assert df.columns[0] == "date" and df.count() > 0


def test_every_query_has_sql():
    assert set(NAMES) <= set(ORACLES) and set(NAMES) <= set(queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, sf_dir, name):
    result = compare(spark, con, sf_dir, name, queries()[name], ORACLES.get(name))
    assert result.startswith("ok"), result
