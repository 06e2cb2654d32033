"""Every registered query against its SQL oracle (DuckDB) at sf0.001."""

import datetime as dt

import pytest

import __spark_entry__ as ent
from tests.conftest import SF_SMALL

TABLES = ["events", "orders", "documents", "pages"]
LLM = ("op", "pipeline")  # tested in tests/llm


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return repr(round(v, 6))
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


SPARK_TO_DUCK = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "date": "DATE",
                 "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "double": "DOUBLE"}


@pytest.mark.parametrize("name", sorted(n for n in ent.oracle_sql() if not n.startswith(LLM)))
def test_query_matches_oracle(spark, duck, name):
    df = ent.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(ent.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _digest(df.columns, rows) == _digest(ocols, res.fetchall())
    rel = duck.sql(ent.oracle_sql()[name])
    duck_types = dict(zip(rel.columns, map(str, rel.types)))
    assert {c: SPARK_TO_DUCK.get(t, t) for c, t in df.dtypes} == duck_types


def test_entry_smoke(spark):
    df = ent.entry(spark)
    assert df.count() > 0 and "flag" in df.columns


def test_every_query_has_an_oracle_and_rows(duck):
    own = [n for n in ent.queries() if not n.startswith(LLM)]
    assert set(own) <= set(ent.oracle_sql())
    for n in own:
        assert len(duck.execute(ent.oracle_sql()[n]).fetchall()) > 0, n
