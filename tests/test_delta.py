"""Detection by changes against full passes."""

import random
import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from test_detectors import BEFORE, TODAY, tables  # noqa: F401
from tidemark.operators import deltas
from tidemark.operators.deltas import Store, joined_change, net, weighted
from tidemark.plans import delta, fetch as P
from tidemark.plans.delta import INPUTS, DeltaDetection, as_changes, split_changes
from tidemark.streaming.polling import refresh_on_change


def rows(df):
    return sorted(map(tuple, df.select("id", "serial", "detector", "stamp").collect()))


def full(tables):
    return rows(P.fetch_events(tables, TODAY))


@pytest.fixture
def given(tables):  # noqa: F811
    return {n: tables[n].select(*INPUTS[n].names) for n in INPUTS}


@pytest.mark.parametrize("seed", [1, 2])
def test_any_split_gives_the_full_pass(spark, given, tmp_path, seed):
    pick = random.Random(seed)
    found = DeltaDetection(spark, str(tmp_path / "state"), TODAY, buckets=3)
    parts = {n: [[], []] for n in given}
    for n, df in given.items():
        for r in df.collect():
            parts[n][pick.randrange(2)].append(tuple(r))
    seen = {n: [] for n in given}
    for batch in range(2):
        now = {n: spark.createDataFrame(p[batch], INPUTS[n]) for n, p in parts.items() if p[batch]}
        found.apply(now, batch)
        for n, p in parts.items():
            seen[n] += p[batch]
    assert rows(found.fetch()) == full({n: spark.createDataFrame(r, INPUTS[n]) for n, r in seen.items()}) == full(given)


def test_rows_that_leave_take_their_events_back(spark, given, tmp_path):
    found = DeltaDetection(spark, str(tmp_path / "state"), TODAY, buckets=3)
    found.apply(given, 0)
    assert rows(found.fetch()) == full(given)
    left = {
        "payable_head": [(2, 12, TODAY, TODAY, 130000, "Y", "PV2 , PV3")], "receivable_line": [(1, "b1"), (2, "b3")], "order_line": [(1, "b1")],
        "read_model": [("b4", "zz", "13", None, "", "F"), (None, None, None, None, None, None), (None, None, None, None, None, None)],
        "tp": [("b2", "t", "PV1,PV4")], "pricing": [("b8",)], "payment_line": [(3, 3)],
    }
    came = {"payable_head": [(2, 12, TODAY, TODAY, 140000, "Y", "PV4")], "receivable_head": [(9, 49, TODAY, TODAY, 1, "N")]}
    of = lambda many, n: spark.createDataFrame(many.get(n, []), INPUTS[n])
    changed = {n: weighted(of(came, n)).unionByName(of(left, n).withColumn("weight", F.lit(-1).cast("bigint"))) for n in {*left, *came}}
    after = {n: df.exceptAll(of(left, n)).unionByName(of(came, n)) for n, df in given.items()}
    for _ in range(2):  # a batch that is run again replaces itself
        found.apply(changed, 1)
        assert rows(found.fetch()) == full(after)
    # Without NULL keys in the read model, bookings that it lacks are heard of.
    assert "MISSING" in {r[2] for r in rows(found.events())} and "MISSING" not in {r[2] for r in full(given)}
    back = {n: df.withColumn("weight", -F.col("weight")) for n, df in changed.items()}
    found.apply(back, 2)
    assert rows(found.fetch()) == full(given)


def test_a_batch_reads_its_keys_only(spark, frame, tmp_path):
    left, right = (Store(spark, str(tmp_path / n), f"k bigint, {n} string", ("k",), 16) for n in ("a", "b"))
    for n, store in (("a", left), ("b", right)):
        store.add(weighted(frame([(k, f"{n}{k}") for k in range(200)], f"k bigint, {n} string")), 0)
    left.add(weighted(frame([(7, "new"), (None, "none")], "k bigint, a string")), 1)
    change = joined_change(left, right, 1, True, False)
    assert [tuple(r) for r in change.collect()] == [(7, "new", "b7", 1)]
    (bucket,) = left.touched(1)
    plan = right.at(1, left.of(1), [bucket])._jdf.queryExecution().executedPlan().toString()
    assert re.search(rf"PartitionFilters: \[[^\]]*bucket#\d+ = {bucket}\)", plan)


def held_by_a_task(df):
    """The most sorts and groups that one task of ``df`` holds: what lies between two exchanges, over all sides of its joins."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    nodes = [(len(m[1]), m[2]) for m in re.finditer(r"^([ :+-]*)(?:\* ?)?(?:\(\d+\) )?(\w+)", plan.split("== Initial Plan ==")[-1], re.M)]
    most, open_ = 0, []  # of the nodes above: depth, and the counts of the task they are in

    for depth, name in nodes:
        while open_ and open_[-1][0] >= depth:
            open_.pop()
        within = open_[-1][1] if open_ and not re.search("Exchange|Union", open_[-1][2]) else [0]
        within[0] += name in ("Sort", "HashAggregate", "ObjectHashAggregate")
        most = max(most, within[0])
        open_.append((depth, within, name))
    return most, plan


@pytest.mark.parametrize("again", [False, True])
def test_a_task_holds_few_sorts_and_groups_and_no_side_is_broadcast(spark, given, tmp_path, monkeypatch, again):
    found, written, write, add = DeltaDetection(spark, str(tmp_path / "state"), TODAY, buckets=3), [], deltas.materialize, Store.add
    if again:
        found.apply(given, 0)
    for module in (deltas, delta):
        monkeypatch.setattr(module, "materialize", lambda df: written.append(df) or write(df))
    monkeypatch.setattr(Store, "add", lambda store, rows, batch: written.append(rows) or add(store, rows, batch))
    found.apply(given, 1)
    held = [held_by_a_task(df) for df in written]
    assert not [plan for _, plan in held if "Broadcast" in plan]
    assert 3 < max(n for n, _ in held) <= 9, [plan for n, plan in held if n > 9]


def test_hot_keys_cost_their_rows_only_when_a_newer_event_comes(spark, given, tmp_path):
    blank = {
        "payable_head": spark.createDataFrame([(k, k, TODAY, TODAY, k, "N", "") for k in range(1, 60)], INPUTS["payable_head"]),
        "tp": spark.createDataFrame([(f"c{k}", "t", "") for k in range(60)], INPUTS["tp"]),
    }
    found = DeltaDetection(spark, str(tmp_path / "state"), TODAY, buckets=3)
    found.apply(given, 0)
    found.apply(blank, 1)
    view = found.stores["view"]
    assert view.of(1).count() < 59 * 3 and rows(found.fetch()) == full(given | {n: given[n].unionByName(df) for n, df in blank.items()})
    found.apply({"payable_head": spark.createDataFrame([(99, 99, TODAY, TODAY, 0, "N", "")], INPUTS["payable_head"])}, 2)
    assert view.of(2).count() == 0


def test_stream_of_changes(spark, given, tmp_path):
    landing, seen = str(tmp_path / "landing"), []
    found = DeltaDetection(spark, str(tmp_path / "state"), TODAY, buckets=3)
    source = lambda: spark.readStream.schema("`table` string, weight bigint, row string").parquet(landing)
    ledger = lambda: spark.createDataFrame([("b2", "AP11-1998060193005")], "id string, serial string")
    run = lambda: refresh_on_change(source(), found, lambda e: seen.append(rows(e)), str(tmp_path / "cp"), ledger, "available_now").awaitTermination()
    first = {n: df for n, df in given.items() if not n.startswith("receivable")}
    as_changes(first).write.parquet(landing)
    run()
    as_changes({n: df for n, df in given.items() if n.startswith("receivable")}).write.mode("append").parquet(landing)
    run()
    assert len(seen) == 2 and seen[-1] == rows(P.fetch_events(given, TODAY, ledger()))
    assert set(split_changes(as_changes(first))) == set(first)
    with pytest.raises(ValueError, match="unknown tables"):
        found.apply({"other": given["tp"]}, 3)
    assert net(found.stores["item"].until()).count() == 3 and BEFORE < date(1998, 6, 1)
