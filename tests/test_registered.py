"""Every registered query against its SQL, and what their plans must not contain."""

import inspect
import shutil
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from checks.compare import connect, difference
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"
WRITES = {
    "bronze_scan",
    "land_window_dedup",
    "land_entity_dedup",
    "land_hash_dedup",
    "rejected_payloads",
    "upsert_bootstrap",
    "upsert_empty_batch",
    "rolling_rebuild",
    "upsert_merge",
    "upsert_wider_batch",
    "upsert_out_of_order",
    "corrected_group_rebuild",
    "silver_stream",
    "layers_end_to_end",
}


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_sql(spark, duck, name):
    _, problem = difference(spark, duck, name, SF)
    assert not problem


def test_every_query_has_sql():
    assert not QUERIES.keys() - driver.oracle_sql().keys()


def test_entry_has_rows_and_a_stable_schema(spark):
    first, second = driver.entry(spark), driver.entry(spark)
    assert first.schema == second.schema
    assert not first.isEmpty()


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - WRITES))
def test_plan_has_no_cross_join_or_python(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert bad not in plan


@pytest.mark.parametrize(
    "name, most", [("state_demand_mart", 3), ("adequacy_mart", 4), ("weather_demand_mart", 5), ("national_grid_mart", 4)]
)
def test_marts_read_their_inputs_once(spark, name, most):
    """Scans that return rows; the other ones are replaced by what an equal exchange has computed."""
    QUERIES[name](spark, SF).collect()
    store = spark._jsparkSession.sharedState().statusStore()
    runs = store.executionsList()
    run = runs.apply(runs.size() - 1).executionId()
    values, scans = store.executionMetrics(run), 0
    nodes = store.planGraph(run).allNodes()
    for k in range(nodes.size()):
        node = nodes.apply(k)
        metrics = [node.metrics().apply(m) for m in range(node.metrics().size())]
        found = [m.accumulatorId() for m in metrics if m.name() == "number of output rows"]
        if node.name().startswith("Scan parquet"):
            scans += any(values.contains(i) and values.apply(i).split("\n")[-1] not in ("0", "") for i in found)
    assert 0 < scans <= most


def test_rejected_payloads_are_written_without_a_sort(spark):
    store = spark._jsparkSession.sharedState().statusStore()

    def executions():
        runs = store.executionsList()
        return [runs.apply(k) for k in range(runs.size())]

    last = max((run.executionId() for run in executions()), default=-1)  # the store forgets the oldest of many
    QUERIES["rejected_payloads"](spark, SF)
    plans = [run.physicalPlanDescription() for run in executions() if run.executionId() > last]
    writes = [plan for plan in plans if "WriteFiles" in plan]
    assert len(writes) == 2 and not any("Sort" in plan for plan in writes)


def test_library_collects_nothing():
    import voltlake.operators.incremental as incremental
    import voltlake.operators.landing as landing
    import voltlake.operators.rollups as rollups
    import voltlake.operators.upsert as upsert

    for module in (incremental, landing, rollups, upsert):
        source = inspect.getsource(module)
        assert ".collect(" not in source and ".toPandas(" not in source


def test_layers_keep_payloads_of_one_state_and_time_apart(spark, tmp_path):
    """Every event has a twin in its state at its time: from another source, with more demand, and warmer."""
    for table in Path(SF).iterdir():
        shutil.copyfile(table, tmp_path / table.name)
    with duckdb.connect() as con:
        con.execute(
            f"""COPY (SELECT * FROM '{SF}/events.parquet' UNION ALL
              SELECT event_id + 1000000, ts, user_id + 25,
                CASE event_type WHEN 'error' THEN 'view' WHEN 'view' THEN 'error'
                  WHEN 'click' THEN 'purchase' ELSE 'click' END,
                value + 1, concat('{{"k": ', 100 + CAST(props->>'k' AS BIGINT), '}}')
              FROM '{SF}/events.parquet') TO '{tmp_path}/events.parquet' (FORMAT parquet)"""
        )
    _, problem = difference(spark, connect(tmp_path), "layers_end_to_end", str(tmp_path))
    assert not problem
