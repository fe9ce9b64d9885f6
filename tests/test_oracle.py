"""Every registered query against its DuckDB oracle (the driver's correctness gate, at sf0.001)."""

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_oracle import canon
from yieldspark.plans import catalog
from yieldspark.sources.tables import TABLES, path

SF = "/root/testdata/sf0.001"
KEYS = sorted(catalog.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path(SF, t)}')")
    return c


def test_every_query_has_an_oracle():
    assert set(KEYS) <= set(entry.queries())
    assert set(KEYS) <= set(entry.oracle_sql())
    assert len(KEYS) >= 61


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(entry.oracle_sql()[key])
    orows = res.fetchall()
    ocols = [d[0] for d in res.description]
    assert canon(df.columns, rows) == canon(ocols, orows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.schema == entry.entry(spark).schema
