"""The registered queries that have SQL against it, over the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from packedts.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def plain(rows):
    return sorted(tuple(map(str, row)) for row in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, tables, name):
    found = QUERIES[name](spark, SF_DIR)
    columns = sorted(tables.sql(ORACLES[name]).columns)
    assert sorted(found.columns) == columns
    rows = tables.sql(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()
    assert plain(found.select(*columns).collect()) == plain(rows)
    assert rows


def test_all_are_registered():
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())
    assert "pipeline" in queries()
