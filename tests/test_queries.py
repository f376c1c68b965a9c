"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from carelake.plans import ORACLES, QUERIES
from tools.check_oracle import TABLES, normal

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, con):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [step for step in ("CartesianProduct", "NestedLoop", "EvalPython", "InPandas") if step in plan]
    columns = sorted(df.columns)
    rows = sorted(tuple(normal(r[c]) for c in columns) for r in df.collect())
    cur = con.execute(ORACLES[name])
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    expected = sorted(tuple(normal(r[i]) for i in order) for r in cur.fetchall())
    assert columns == sorted(names)
    assert rows == expected


def test_entry(spark):
    assert entry.entry(spark).count() > 0
