"""Every registered query against its SQL twin, on the smallest tables."""

import pytest

import __spark_entry__ as entry_points
from quayside.queries import ORACLES, QUERIES
from tests.compare import connect, difference

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    assert name in ORACLES
    assert difference(spark, con, name, SF) is None


def test_register_holds_all():
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLES) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns[0] == "DT" and df.count() == spark.read.parquet(f"{SF}/lineitem.parquet").count()
