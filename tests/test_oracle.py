"""Every named query against its DuckDB SQL, over whole tables."""

import math
import os

import duckdb
import pytest

from __spark_entry__ import entry
from postlark.plans.oracles import ORACLES
from postlark.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

SPARK_TYPES = {"VARCHAR": "string", "BIGINT": "bigint", "DOUBLE": "double"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(v)
        return repr(v)

    return sorted(columns), sorted(tuple(value(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry(spark).columns == ["hashtag", "avgLength"]
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    actual = canonical(df.columns, [tuple(row) for row in df.collect()])
    result = duck.execute(ORACLES[name])
    columns = [column[0] for column in result.description]
    types = {column[0]: SPARK_TYPES[str(column[1])] for column in result.description}
    assert dict(df.dtypes) == types
    expected = canonical(columns, result.fetchall())
    assert actual[0] == expected[0]
    assert len(actual[1]) == len(expected[1]) > 0
    assert actual[1] == expected[1]
