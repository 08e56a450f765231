"""Every registered query with a SQL twin equals DuckDB on sf0.001 (the
driver's gate runs the same comparison at sf0.01: tests/oracle_check.py)."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from basketlab.fixtures import TABLES
from basketlab.plans.oracle_sql import ORACLE
from basketlab.plans.queries import QUERIES
from oracle_check import digest

SF = "/root/testdata/sf0.001"
KEYS = sorted(ORACLE)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def executed(spark) -> dict[int, str]:
    """Physical plans of the statements that ran, eager ones included."""
    found = spark._jsparkSession.sharedState().statusStore().executionsList()
    return {found.apply(i).executionId(): found.apply(i).physicalPlanDescription() for i in range(found.size())}


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_sql(spark, con, key):
    before = max(executed(spark), default=-1)
    sdf = QUERIES[key](spark, SF)
    pdf = pd.DataFrame([r.asDict() for r in sdf.collect()], columns=sdf.columns)
    plans = [p for i, p in executed(spark).items() if i > before]
    assert plans
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "InPandas", "InArrow"):
        assert not any(word in p for p in plans), (key, word)
    assert digest(pdf) == digest(con.execute(ORACLE[key]).df())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["CustomerID", "gross_revenue", "recency_days", "qty_products",
                          "frequency", "qty_returns"]
    assert df.count() > 0


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE) <= set(E.queries())
