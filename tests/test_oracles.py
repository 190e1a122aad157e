"""Every registered query against its DuckDB oracle on the smallest driver tables
(the driver runs the same comparison at sf0.01)."""

import duckdb
import pytest

import __spark_entry__ as entry
from livepulse.plans import registry
from tools.oracle_check import TABLES, rows_of

SF = "/root/testdata/sf0.001"
entry.queries()                       # loads the registry
QUERIES, ORACLES = registry.QUERIES, registry.ORACLES


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns == ["language", "avg_viewers", "max_viewers"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF)
    cols = sorted(sdf.columns)
    got = rows_of([r.asDict() for r in sdf.collect()], cols)
    cur = con.execute(ORACLES[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(dcols) == cols
    exp = rows_of([dict(zip(dcols, r)) for r in cur.fetchall()], cols)
    assert len(got) == len(exp)
    assert got == exp
