"""Joins whose sides grow with the input gather none of them in the driver, however small the planner takes them to be."""

import pytest
from pyspark.sql import DataFrameWriter

import __spark_entry__ as entry
from workload import queries
from workload.queries import _rebuild

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["contains_join", "detect_ap", "multivalue_join", "row_disabled_flag", "model_rows"])
def test_no_side_is_broadcast(spark, name):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


@pytest.mark.parametrize("name", ["fetch_events", "fetch_exclude_then_dedupe"])
def test_no_side_of_a_fetch_is_broadcast(spark, name):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_rebuilding_rows_broadcasts_no_side(spark):
    """What ``process_partial_failure`` runs for each part of the ids."""
    ids = entry.queries()["read_table_source"](spark, SF).selectExpr("CAST(o_orderkey AS STRING) AS booking_id")
    plan = _rebuild(spark, SF)(ids)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 2 and "Broadcast" not in plan


def test_messages_are_routed_without_broadcasts(spark):
    """The outbox by the step that ``lock_stream_outbox`` runs for each batch."""
    plan = entry.queries()["outbox"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


@pytest.mark.parametrize("name", ["lock_stream_outbox", "process_partial_failure"])
def test_no_table_on_the_way_is_written_with_a_broadcast(spark, monkeypatch, name):
    """Every batch of the stream, every part of the ids and every write of the read model."""
    plans = []

    def write(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return DataFrameWriter(df)

    monkeypatch.setattr(queries, "_STREAMS", {})
    monkeypatch.setattr(type(spark.range(1)), "write", property(write))
    result = entry.queries()[name](spark, SF)
    plans.append(result._jdf.queryExecution().executedPlan().toString())
    assert sum("SortMergeJoin" in p for p in plans) >= 3
    assert not [p for p in plans if "Broadcast" in p]
