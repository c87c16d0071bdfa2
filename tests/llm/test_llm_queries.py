"""The operators' queries against their SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from reviewloom.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


def _plain(value):
    return int(value) if isinstance(value, float) and value == int(value) else value


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(llm, name):
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.splitext(os.path.basename(path))[0]} AS SELECT * FROM '{path}'")
    answer = con.execute(ORACLES[name])
    columns = sorted(d[0] for d in answer.description)
    at = [[d[0] for d in answer.description].index(c) for c in columns]
    want = sorted(repr([_plain(r[i]) for i in at]) for r in answer.fetchall())
    rows = QUERIES[name](llm, SF_DIR)
    assert sorted(rows.columns) == columns
    assert sorted(repr([_plain(r[c]) for c in columns]) for r in rows.collect()) == want


def test_all_are_registered():
    names = set(entry_module.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(ORACLES) <= set(entry_module.oracle_sql())
