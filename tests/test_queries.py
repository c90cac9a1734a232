"""Every registered query against its SQL on the smallest tables."""

import warnings

import pytest

import __spark_entry__ as entry_points
from stayledger.checks import queries as registered
from compare import differences, engine

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return engine(SF)


def test_every_query_has_sql():
    assert set(registered.queries()) == set(registered.oracle_sql())


@pytest.mark.parametrize("key", sorted(registered.queries()))
def test_query_equals_sql(spark, con, key):
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        df = registered.queries()[key](spark, SF)
        assert differences(df, con, registered.oracle_sql()[key]) == ""


def test_entry_has_one_row(spark):
    assert entry_points.entry(spark).count() == 1
