"""Every registered query against its SQL on the smallest test data."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from checks.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data here")


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    yield con
    con.close()


def by_name(rows, columns):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(r[i] for i in order) for r in rows), key=lambda r: str(r))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, tables, name):
    result = entry_module.queries()[name](spark, SF_DIR)
    answer = tables.execute(entry_module.oracle_sql()[name])
    columns = [d[0] for d in answer.description]
    assert sorted(result.columns) == sorted(columns)
    want = by_name(answer.fetchall(), columns)
    assert want, "an empty answer checks nothing"
    assert by_name(map(tuple, result.collect()), result.columns) == want


def test_every_review_query_has_sql(spark):
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_module.queries()) and set(ORACLES) <= set(entry_module.oracle_sql())
    assert entry_module.queries()["preview"](spark, SF_DIR).count() == 5


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["name", "rating", "comments"] and df.count() > 0
