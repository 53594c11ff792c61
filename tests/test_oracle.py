"""Every registered query against its DuckDB oracle (the driver's check, at sf0.001)."""

import pytest

import __spark_entry__ as E
from oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"
CORPUS = set(E._corpus()[0])  # tested with their own package
QUERIES = {k: v for k, v in E.queries().items() if k not in CORPUS}
SQL = {k: v for k, v in E.oracle_sql().items() if k not in CORPUS}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    from starforge.plans.catalog import ROWS_ONLY
    assert set(QUERIES) == set(SQL) and not ROWS_ONLY


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["payment_status", "n", "pct"]
    assert df.count() > 0


FORBIDDEN = ["BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin",
             "PythonUDF"]


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle_and_plan_is_clean(spark, con, name):
    """Same rows as the oracle; the executed plan has no Python UDF, cartesian
    product or nested-loop join."""
    df = QUERIES[name](spark, SF)
    ok, msg = compare(df, con, SQL[name])
    assert ok, msg
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name}: {bad}"


def test_fact_scan_reads_only_needed_columns(spark):
    import re
    df = QUERIES["fact_payments"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    schemas = re.findall(r"lineitem\.parquet.*?ReadSchema: (struct<[^>]*>)", plan)
    assert schemas, plan
    for rs in schemas:  # l_discount, l_tax, ... are never read
        assert "l_discount" not in rs and "l_tax" not in rs
