"""Every registered query against its SQL on the smallest test tables."""

import importlib.util
import pathlib
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT / "tools"))

import compare  # noqa: E402

from workload import oracle  # noqa: E402
from workload.queries import registered  # noqa: E402


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.connect(sf_dir)


def test_every_query_has_sql():
    assert set(registered()) == set(oracle.statements())


@pytest.mark.parametrize("name", sorted(registered()))
def test_query_equals_sql_in_a_native_plan(spark, sf_dir, con, name):
    df = registered()[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in plan
    got = compare.spark_rows(df)
    assert len(got) > 0
    assert compare.difference(got, compare.rows_of(con, oracle.statements()[name])) is None


def executed(plan: str) -> list[str]:
    """Lines of what ran: the final plans, subqueries included, without the initial ones."""
    out, skip = [], None
    for line in plan.splitlines():
        column = next((k for k, c in enumerate(line) if c.isalnum() or c in "*="), 0)
        if skip is not None and column >= skip:
            continue
        skip = line.index("==") if "== Initial Plan ==" in line else None
        if skip is None:
            out.append(line)
    return out


@pytest.mark.parametrize("name", ["run_rate", "run_rate_range", "run_rate_details", "zero_filled_daily_sales", "demand_shape", "inventory_status",
                                  "sales_vs_run_rate", "product_daily_series"])
def test_facts_are_read_once(spark, sf_dir, name):
    df = registered()[name](spark, sf_dir)
    df.collect()
    lines = executed(df._jdf.queryExecution().executedPlan().toString())
    assert len([x for x in lines if "FileScan" in x and "lineitem.parquet" in x]) == (2 if name == "run_rate_details" else 1)
    assert not any("RoundRobinPartitioning" in x for x in lines)


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    plan = registered()["run_rate"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    lines = {line.split("ReadSchema: ")[1] for line in scans if "lineitem.parquet" in line}
    assert lines == {"struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>"}
    orders = [line for line in scans if "/orders.parquet" in line]
    assert all("GreaterThanOrEqual(o_orderdate" in line for line in orders)


def test_entry_point(spark, sf_dir):
    spec = importlib.util.spec_from_file_location("spark_entry", ROOT / "__spark_entry__.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    assert module.entry(spark).columns[:2] == ["inventory_id", "run_rate"]
    assert set(registered()) <= set(module.queries())
    assert set(module.oracle_sql()) <= set(module.queries())

