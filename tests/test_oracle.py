"""Every registered query against its DuckDB oracle on the smallest tables
(the driver runs the same check at sf0.01)."""

import datetime as dt
import decimal
import hashlib

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, (float, decimal.Decimal)):
        return f"{float(v):.9g}"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return str(v).lower()
    return str(v)


def _digest(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in data)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    """Queries of the optional training-data subpackage that SQL cannot express have tests of their own."""
    core = {n for n in E.queries() if n != "pipeline" and not n.startswith("op")}
    assert core <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["task_name", "state", "scheduled_time", "event_id"]
    df.collect()


# Operators a registered query must never plan: pair explosion, nested
# loops, row-at-a-time Python, executor-local checkpoints.
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "LocalCheckpoint")


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    plan = sdf._jdf.queryExecution().executedPlan().toString()
    assert not [t for t in FORBIDDEN if t in plan], plan
    s_rows = [tuple(r) for r in sdf.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert _digest(sdf.columns, s_rows) == _digest(d_cols, d_rows)
