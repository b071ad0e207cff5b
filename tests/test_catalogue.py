"""Every registered query of the core against its SQL in DuckDB, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from assay.plans import catalogue

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for p in Path(DATA).glob("*.parquet"):
        c.execute(f"create view {p.stem} as select * from read_parquet('{p}{'/*.parquet' if p.is_dir() else ''}')")
    return c


def plain(v):
    if v is None or v != v:
        return "null"
    return f"{v:.8g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_matches_sql(spark, con, name):
    df = catalogue.QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    cur = con.execute(catalogue.ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    want = sorted(tuple(plain(r[names.index(c)]) for c in cols) for r in cur.fetchall())
    assert got == want
