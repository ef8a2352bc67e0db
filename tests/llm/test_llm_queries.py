"""Every registered query against its SQL equivalent; those without one must give rows."""

import os
import pathlib

import duckdb
import pytest

from flowops.llm.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in pathlib.Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF_DIR)
    mine = got.collect()
    assert len(mine) > 0
    if name in ORACLES:
        found = duck.execute(ORACLES[name])
        columns = [d[0] for d in found.description]
        theirs = rows_of(columns, found.fetchall())
        assert sorted(got.columns) == sorted(columns)
        assert rows_of(got.columns, mine) == theirs
