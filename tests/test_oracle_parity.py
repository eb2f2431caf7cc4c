"""Every registered query against its DuckDB oracle on sf0.001
(order-insensitive, exact values), and rows-only for items without SQL."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_mod
from scripts.check_oracle import TABLES, norm

SF = "/root/testdata/sf0.001"
QUERIES = {k: v for k, v in entry_mod.queries().items() if k in entry_mod.REGISTRY}
ORACLES = entry_mod.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # scale guard: no query pairs rows by nested loops or cartesian products
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    got = df.toPandas()
    if key not in ORACLES:
        assert len(got.columns) > 0
        return
    exp = con.execute(ORACLES[key]).df()
    assert sorted(got.columns) == sorted(exp.columns)
    assert norm(got) == norm(exp)


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert "EventDate" in df.columns


GRAINS = ["E13_work_events_v1", "E18_work_events", "R05_by_user_work_type", "R06_by_port_work_type", "R09_daily", "P29_throughput",
          "P30_inventory_location_summary", "S03_dedupe_metrics"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _unmaterialised(spark):
    t = entry_mod.Tables(spark, SF)
    t.materialize = False
    return t


@pytest.mark.parametrize("key", GRAINS)
def test_grains_plan_without_nested_loops(spark, key):
    """The plans behind the stored tables, which their readers' plans do not show."""
    plan = _plan(entry_mod.REGISTRY[key][0](_unmaterialised(spark)))
    assert "Join" in plan or "Aggregate" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_guard_sees_a_planted_nested_loop(spark, monkeypatch):
    from opsgrain.operators import events

    real = events.session_events
    monkeypatch.setattr(events, "session_events", lambda s: real(s.join(s.sparkSession.range(2), s["SessionMs"] > F.col("id"))))
    plan = _plan(entry_mod.REGISTRY["E18_work_events"][0](_unmaterialised(spark)))
    assert "BroadcastNestedLoopJoin" in plan or "CartesianProduct" in plan


@pytest.mark.parametrize(("key", "table", "most"), [("M55_units_picked", "lineitem", 0), ("P30_inventory_location_summary", "lineitem", 2),
                                                    ("Q28_visible_kpi", "lineitem", 19)])
def test_scans_of_the_large_table(spark, key, table, most):
    plan = _plan(entry_mod.REGISTRY[key][0](_unmaterialised(spark)))
    plan = plan.split("== Initial Plan ==")[0]
    assert sum("FileScan parquet" in x and f"{table}.parquet" in x for x in plan.splitlines()) <= most
