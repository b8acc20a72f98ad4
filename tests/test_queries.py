import pytest

import oracle
from __spark_entry__ import entry, oracle_sql, queries
from moorline.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, duck, name):
    assert oracle.compare(queries()[name](spark, FOLDER), duck, oracle_sql()[name]) > 0


def test_entry(spark):
    assert entry(spark).count() > 0
