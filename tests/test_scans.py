import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.intervals import stab_join
from tidemark.operators.merge import union_detectors
from tidemark.operators.scans import number_rows, scan_before
from tidemark.operators.snapshots import pending_snapshots


def expected(rows, descending):
    out = {}
    for key in {r[0] for r in rows}:
        top, total, last = None, 0, None
        for k, at, v in sorted((r for r in rows if r[0] == key), key=lambda r: r[1], reverse=descending):
            out[(k, at)] = (top, total, last)
            if v is not None:
                top = v if top is None else max(top, v)
                total += v
                last = v
    return out


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("parts", [1, 7])
def test_scan_with_hot_and_null_keys(frame, descending, parts):
    rng = random.Random(parts)
    keys = ["hot"] * 60 + [None] * 20 + [f"k{i}" for i in range(20)]
    rows = [(rng.choice(keys), at, rng.choice([None, rng.randrange(100)])) for at in range(400)]
    df = frame(rows, "k string, at int, v bigint")
    aggregates = {"top": ("max", F.col("v")), "total": ("sum", F.col("v")), "prev": ("last", F.col("v"))}
    got = scan_before(df, ["k"], ["at"], aggregates, descending, parts).collect()
    assert {(r.k, r.at): (r.top, r.total, r.prev) for r in got} == expected(rows, descending)
    assert len(got) == len(rows)


def test_keys_that_fit_a_task_take_one_shuffle_and_no_copy(frame):
    rows = [(f"k{i % 9}", i, i) for i in range(200)]
    scanned = scan_before(frame(rows, "k string, at int, v bigint"), ["k"], ["at"], {"top": ("max", F.col("v"))})
    plan = scanned._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "FileScan" not in plan


def test_scan_of_nothing(frame):
    empty = frame([], "k string, at int, v bigint")
    for keys in (["k"], []):
        assert scan_before(empty, keys, ["at"], {"top": ("max", F.col("v"))}, parts=3).collect() == []


def test_number_rows(frame):
    df = frame([(i * 37 % 101,) for i in range(101)], "x int")
    assert sorted((r.x, r.step) for r in number_rows(df, ["x"], parts=5).collect()) == [(i, i + 1) for i in range(101)]


def test_pending_snapshots(frame):
    events = union_detectors({"AR": frame([(str(i), f"AR{i}-1998060{i % 9 + 1}") for i in range(25)], "id string, serial string")})
    got = sorted(pending_snapshots(events, top_n=4, parts=3).collect(), key=lambda r: r.step)
    order = [r.id for r in got[:-1]]
    assert sorted(order) == sorted(str(i) for i in range(25))
    assert [r.pending for r in got] == list(range(25, -1, -1))
    assert [r.pending_ids for r in got] == [order[i : i + 4] for i in range(26)]


def test_stab_join_gives_each_pair_once(frame):
    rng = random.Random(3)
    points = [(i, rng.choice("ab"), rng.randrange(0, 5000)) for i in range(300)]
    spans = []
    for i in range(200):
        start = rng.randrange(0, 5000)
        spans.append((i, rng.choice("ab"), start, start + rng.choice([0, 1, 7, 8, 63, 512, 5000])))
    got = stab_join(
        frame(points, "p int, k string, at bigint"), frame(spans, "s int, k string, start bigint, end bigint"),
        ["k"], "at", "start", "end", levels=3,
    )
    pairs = sorted((r.p, r.s) for r in got.collect())
    assert pairs == sorted((p, s) for p, k, at in points for s, j, a, b in spans if k == j and a <= at <= b)
