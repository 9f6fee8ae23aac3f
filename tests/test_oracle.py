"""The correctness gate, locally: every query against its DuckDB oracle."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF0001
from giftlink.plans.views import TABLES
from tools.check_oracle import rows_hash

NAMES = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF0001}/{t}.parquet'")
    return c


def test_every_query_has_an_oracle():
    """All but those of the optional subpackage that SQL cannot state."""
    without = set(E.queries()) - set(E.oracle_sql())
    assert not set(E.oracle_sql()) - set(E.queries())
    assert all(n.startswith("op") or n == "pipeline" for n in without)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF0001)
    cols = sorted(df.columns)
    srows = [tuple(r[c] for c in cols) for r in df.collect()]
    rel = con.sql(E.oracle_sql()[name])
    dcols = rel.columns
    order = sorted(range(len(dcols)), key=lambda i: dcols[i])
    drows = [tuple(r[i] for i in order) for r in rel.fetchall()]
    assert sorted(dcols) == cols
    assert rows_hash(srows) == rows_hash(drows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["record_id", "match_probability", "match_weight", "constituent", "matched_record_id"]
    assert df.count() >= 0


@pytest.mark.parametrize("name", NAMES)
def test_plan_has_no_nested_loop_or_row_udf(spark, name):
    """No cartesian product, nested-loop join or row-at-a-time Python UDF in
    any query; Python appears only as Arrow-batched evaluation."""
    df = E.queries()[name](spark, SF0001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in plan, (name, bad)
