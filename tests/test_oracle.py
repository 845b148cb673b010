"""Every registered query against its DuckDB oracle (sf0.001, whole tables)."""

import duckdb
import pytest

from conftest import SF_SMALL
from tools.compare import TABLES, rows_of

import __spark_entry__ as entry_mod


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_callable_and_sql():
    qs, sqls = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(sqls) <= set(qs)
    own = {q for q in qs if q != "pipeline" and not q.startswith("op")}
    assert own <= set(sqls)


@pytest.mark.parametrize("name", sorted(entry_mod.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = entry_mod.queries()[name](spark, SF_SMALL)
    cols = df.columns
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(entry_mod.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(srows) == len(orows)
    assert rows_of(srows, cols) == rows_of(orows, ocols)


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert "peer_index" in df.columns
