"""Every catalog query against its DuckDB oracle on the smallest tables."""

import pytest

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as E  # noqa: E402
from conftest import SF_SMALL  # noqa: E402
from tools.check_oracle import TABLES, digest  # noqa: E402


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(E.ORACLE))
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_regression_reports_every_term(spark):
    assert set(E.QUERIES) == set(E.ORACLE) == set(E.oracle_sql()) - set(E.LLM_ORACLE)
    out = E.queries()["pm_regression"](spark, SF_SMALL)
    terms = {r["term"]: r["estimate"] for r in out.collect()}
    assert set(terms) == {"intercept", "l_quantity", "l_discount", "l_tax", "r2", "rmse"}
    assert 0.0 <= terms["r2"] <= 1.0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "event_ts" in df.columns
