"""Every registered query with SQL gives the rows of its SQL."""

import pytest
from conftest import SF_DIR
from oracle import connect, differences

import __spark_entry__ as entry
from forecourt.registry.oracles import ORACLES
from forecourt.registry.queries import QUERIES


@pytest.fixture(scope="module")
def database():
    return connect(SF_DIR)


def test_keys_agree():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_sql(spark, database, key):
    rows = QUERIES[key](spark, SF_DIR).toArrow()
    assert rows.num_rows > 0
    assert differences(rows, database.sql(ORACLES[key]).to_arrow_table()) == []


def test_entry_has_ten_rows(spark):
    frame = entry.entry(spark)
    assert frame.columns == [
        "brand", "model", "avg_price_compliant", "avg_price_non_compliant",
        "devaluation_amount", "devaluation_percent",
    ]
    assert frame.count() == 10
