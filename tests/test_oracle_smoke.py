"""Every registered query against its DuckDB oracle on the smoke tables,
plus plan hygiene: no Cartesian products or nested-loop joins, and Python
only where the similarity LCS needs it."""

import pytest

from tools.check_oracle import compare, duck_connection
from ledgerlens.plans import registry

from conftest import SMOKE

QUERIES = registry.queries()
ORACLE = registry.oracle_sql()
PYTHON_ALLOWED = {"semelhanca_convenios", "enriquecimento"}
FORBIDDEN_NODES = ["CartesianProduct", "BroadcastNestedLoopJoin"]


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SMOKE)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SMOKE)
    plan = _plan(df)
    for node in FORBIDDEN_NODES:
        assert node not in plan, f"{name}: {node} in plan"
    if name not in PYTHON_ALLOWED:
        assert "EvalPython" not in plan, f"{name}: Python UDF in plan"
    rec = compare(spark, duck, name, QUERIES[name], ORACLE.get(name), SMOKE, df=df)
    assert rec["status"] in ("ok", "rows-only"), rec


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() >= 0 and df.columns
