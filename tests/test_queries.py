"""Every query of the archive engine against its SQL, over the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from packedts.plans.oracles import ORACLES
from packedts.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def plain(rows):
    return sorted(tuple(map(str, row)) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tables, name):
    found = QUERIES[name](spark, SF_DIR)
    expected = tables.sql(ORACLES[name])
    columns = sorted(expected.columns)
    assert sorted(found.columns) == columns
    rows = tables.sql(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()
    assert plain(found.select(*columns).collect()) == plain(rows)
    assert rows


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries())
    assert set(ORACLES) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
