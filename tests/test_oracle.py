"""Every registered query with SQL gives the same rows as DuckDB on the small tables."""

import pytest

from check_oracle import compare, connect
from topicloom.catalog import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
NAMES = [n for n in QUERIES if n in ORACLES]


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, db, name):
    rows, problem = compare(spark, db, FOLDER, name, QUERIES[name], ORACLES[name])
    assert problem is None
    assert rows > 0


def test_sql_belongs_to_queries():
    assert set(ORACLES) <= set(QUERIES)
