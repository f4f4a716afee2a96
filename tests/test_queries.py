"""Every named query against its SQL on the small tables."""

import pytest
from check_oracles import compare, duck

import __spark_entry__ as entry
from kerbside.queries import QUERIES as PLANNING

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], ORACLES[name], SF) is None


def test_every_text_belongs_to_a_query_and_every_planning_query_has_one():
    assert set(ORACLES) <= set(QUERIES)
    assert set(PLANNING) <= set(ORACLES)


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["stop_id", "road_id", "order", "latitude", "longitude", "distance"] and df.count() == 25
