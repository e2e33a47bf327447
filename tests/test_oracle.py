"""Every registered query against its DuckDB oracle on sf0.001 (row count,
column names and an order-insensitive value hash)."""

import duckdb
import pytest

import __spark_entry__ as entry
from check_oracle import table_hash
from chatframe.plans.catalog import QUERIES
from chatframe.sources.tables import TABLES

SF_SMOKE = entry.SMOKE_DIR
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMOKE}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMOKE)
    rows = [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql()[name]
    cur = con.execute(sql)
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert table_hash(df.columns, rows) == table_hash(ocols, orows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and df.columns == ["dimension", "base", "lora", "diff"]
