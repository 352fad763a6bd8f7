"""Every plan of the catalog against DuckDB on the small tables."""

import os

import pytest

from tidewater.plans import adapters, catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for table in adapters.TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(tuple(str(r[k]) for k in order) for r in rows)


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")
@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_plan(spark, duck, name):
    got = catalog.QUERIES[name](spark, SF)
    want = duck.sql(catalog.ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(got.columns, got.collect()) == _rows(want.columns, want.fetchall())
