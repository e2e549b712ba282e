"""Every registered order-book query against its oracle in DuckDB, and the shape of the driver's entry points."""

import duckdb
import pytest

import __spark_entry__ as entry
import verify
from quaybook import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in verify.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_oracle(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    got = verify.digest([tuple(r) for r in df.collect()], df.columns)
    cursor = duck.execute(catalog.ORACLE_SQL[name])
    columns = [c[0] for c in cursor.description]
    assert got == verify.digest(cursor.fetchall(), columns)


def test_entry_points(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns == ["exchange_id", "pair_id", "ord", "id", "trigger_id", "event_time", "last_sequence_id", "asks", "bids"]


def test_full_chain(spark):
    rows = catalog.QUERIES["full_chain"](spark, SF).collect()
    assert rows
    assert {r.side for r in rows} == {"asks", "bids"}
    assert len({(r.pair_id, r.side) for r in rows}) == len(rows)
