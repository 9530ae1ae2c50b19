"""Every registered query against its SQL on the smallest tables."""

import compare
import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def tables():
    return compare.duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, tables, name):
    assert compare.differences(QUERIES[name](spark, SF_DIR), tables, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_has_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns == ["offer_id", "description_clean"]
    assert result.count() == 200
