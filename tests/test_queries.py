"""Every query against its SQL in DuckDB, on the smallest tables."""

import datetime
from pathlib import Path

import pytest

import __spark_entry__ as entry

duckdb = pytest.importorskip("duckdb")
DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="needs the driver's tables")
NAMES = [n for n in entry.queries() if n in entry.oracle_sql() and not n.startswith("op")]


def plain(x):
    if isinstance(x, float):
        return round(x, 6) + 0.0
    if isinstance(x, datetime.datetime):
        return x.date()
    return x


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, tables, name):
    cur = tables.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    want = sorted(repr([plain(r[names.index(c)]) for c in sorted(names)]) for r in cur.fetchall())
    df = entry.queries()[name](spark, str(DATA))
    assert sorted(df.columns) == sorted(names)
    assert sorted(repr([plain(r[c]) for c in sorted(names)]) for r in df.collect()) == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0
