from __future__ import annotations

import pytest

import __spark_entry__ as spark_entry
from oracle import connect, difference

from tidegauge.plans.oracles import ORACLES
from tidegauge.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = connect(SF_DIR)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR).toPandas()
    assert difference(result, duck.execute(ORACLES[name]).df()) is None


def test_every_query_has_its_sql():
    assert set(ORACLES) == set(QUERIES)


def test_the_entry_offers_them():
    assert set(QUERIES) <= set(spark_entry.queries())
    assert set(ORACLES) <= set(spark_entry.oracle_sql())


def test_entry(spark):
    result = spark_entry.entry(spark)
    assert "alerts" in result.columns
    assert result.count() == 935
