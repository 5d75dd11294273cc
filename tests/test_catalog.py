"""Every catalog key against its DuckDB oracle on the smallest driver tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from salesmart.plans.catalog import catalog
from scripts.check_oracle import digest
from tests.conftest import SF_SMALL

TABLES = ["region", "nation", "supplier", "part", "orders", "lineitem"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield con
    con.close()


def test_every_key_has_an_oracle():
    assert set(catalog()) <= set(entry.queries())
    assert set(catalog()) <= set(entry.oracle_sql()) <= set(entry.queries())
    assert len(catalog()) >= 49


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "transaction_date" and df.count() > 0


@pytest.mark.parametrize("name", sorted(catalog()))
def test_key_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)
