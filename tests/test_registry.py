"""Every registered query runs at sf0.001 and matches its SQL oracle (when it has one)."""

import duckdb
import pytest

import __spark_entry__ as E
from cairn.plans.queries import QUERIES
from tests.conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return c


_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
          "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(repr(_norm(r[i])) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan      # no per-row Python UDFs
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert df.columns and rows is not None
        return
    rel = con.sql(sql)
    otypes = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    stypes = {f.name: _TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    assert stypes == otypes
    cur = con.execute(sql)
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, rows) == _rows(ocols, cur.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0


@pytest.mark.parametrize("name", ["stream_tumbling_host", "sessionize", "growth_accounting", "max_wins_90",
                                  "datelist_int", "traffic_windows"])
def test_results_do_not_depend_on_session_settings(spark, con, name):
    old = {k: spark.conf.get(k) for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled",
                                          "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        df = E.queries()[name](spark, SF_SMALL)
        rows = [tuple(r) for r in df.collect()]
        cur = con.execute(E.oracle_sql()[name])
        ocols = [d[0] for d in cur.description]
        assert _rows(df.columns, rows) == _rows(ocols, cur.fetchall())
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
