"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry
from lakeops import catalog

from .compare import connect, differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, con, name):
    assert differences(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name]) == []


@pytest.mark.parametrize("name", ["gld_dim_case", "gld_feat_case", "slv_casos"])
def test_small_tables_have_valid_cases(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLE)


def test_entry_is_the_finance_table(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "anio_mes" and df.count() > 0
