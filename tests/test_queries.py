"""Every registered query against its oracle SQL on the smallest tables."""

import pytest

import catalogue
import catalogue_jobs  # noqa: F401  (registers the jobs)
from compare import difference, oracle

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle(SF)


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_query(spark, con, name):
    got = catalogue.QUERIES[name](spark, SF).toPandas()
    if name in catalogue.ORACLES:
        assert difference(got, con.sql(catalogue.ORACLES[name]).df()) is None
    else:
        assert len(got)


def test_contract(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
