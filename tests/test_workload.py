"""Every registered query runs on the smallest tables and agrees with its SQL."""

import datetime as dt
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(folder):
    con = duckdb.connect()
    for f in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def plain(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, folder, name):
    df = QUERIES[name](spark, folder)
    got = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        assert got
        return
    result = con.execute(ORACLES[name])
    names = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(names)
    assert plain(df.columns, got) == plain(names, result.fetchall())


def test_entry(spark):
    out = entry.entry(spark)
    assert out.columns == ["observation_date", "rows", "churn_rate_30d", "churn_rate_60d", "churn_rate_90d"]
    assert all(isinstance(r["observation_date"], dt.date) for r in out.take(3))


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_works_without_the_optional_modules(monkeypatch):
    from tidemark import workload
    for name in [m for m in sys.modules if m.startswith("tidemark.llm.")]:
        monkeypatch.delitem(sys.modules, name)
    for name in ("tidemark.llm", "corpus_pipeline"):
        monkeypatch.setitem(sys.modules, name, None)
    assert set(entry.queries()) == set(workload.QUERIES)
    assert set(entry.oracle_sql()) == set(workload.ORACLES)
