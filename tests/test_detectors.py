from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.operators.aggregates import LIST_CHARS, doc_counts, doc_list
from tidemark.operators.merge import (
    drop_null_ids,
    exclude_processed,
    first_per_id,
    latest_per_id,
    limit_events,
    run_metrics,
    union_detectors,
)
from tidemark.operators.reconcile import reconcile_numeric, reconcile_text
from tidemark.plans import detectors as D, fetch as P
from tidemark.plans.drift import detect_bvnr, detect_tvnr
from tidemark.schemas import TABLES

TODAY, BEFORE = date(1998, 6, 1), date(1998, 5, 1)
NOW = "19980601000000"


@pytest.fixture
def tables(spark):
    rows = {
        "payable_head": [
            (1, 11, BEFORE, TODAY, 93005, "N", "PV1"),
            (2, 12, TODAY, TODAY, 130000, "Y", "PV2 , PV3"),
            (3, 13, BEFORE, BEFORE, 1, "N", "PV1"),
            (4, 14, TODAY, None, None, "N", None),
        ],
        "payable_line": [(2, "b5"), (4, "b1"), (3, "b2")],
        "payment_head": [
            (1, 21, TODAY, TODAY, 1, "N"), (2, 22, TODAY, TODAY, 2, "Y"), (3, 23, TODAY, TODAY, 3, None),
        ],
        "payment_line": [(1, 1), (1, 2), (2, 3), (3, 3)],
        "order_head": [(1, 31, TODAY, TODAY, 5, "N"), (2, 32, BEFORE, BEFORE, 6, "N")],
        "order_line": [(1, "b1"), (1, "b1"), (1, None), (2, "b2")],
        "receivable_head": [(1, 41, TODAY, TODAY, 7, "N"), (2, 42, BEFORE, BEFORE, 8, "N"), (3, 43, BEFORE, BEFORE, 8, "Y")],
        "receivable_line": [(1, "b1"), (1, "b1"), (2, "b2"), (2, "b3"), (1, "b3"), (3, "b4"), (2, "b6"), (1, "b6")],
        "item": [("b7", TODAY, 90000), ("b8", TODAY, 1), ("b1", TODAY, 1), (None, TODAY, 1), ("b9", BEFORE, 1)],
        "tp": [("b1", "t", "PV9"), ("b2", "t", "PV1,PV4"), ("b3", "t", "PV3"), ("b4", "t", "PV2 , PV3 "), (None, "t", "PV1")],
        "pricing": [("b8", "p", 1.0, 1.0, 1.0, 1.0, 1.0, 1.0)],
        "read_model": [
            ("b1", "31", " 11 ", None, None, None),
            ("b2", "32", "x", "12", "42", "F"),
            ("b3", None, None, None, "42", " "),
            ("b4", "zz", "13", None, "", "F"),
            ("b4", "zz", "13", None, "", "F"),
            ("b6", None, None, None, " 42, 41", "F"),
            (None, None, None, None, None, None),
            (None, None, None, None, None, None),
        ],
    }
    found = {n: spark.createDataFrame(r, TABLES[n]) for n, r in rows.items()}
    pod = [("b1", "F1"), ("b3", "F3"), ("b4", None), ("b7", " "), (None, "F")]
    return found | {"pod": spark.createDataFrame(pod, "booking_id string, ptf_no string")}


def run(name, tables, **options):
    return sorted(map(tuple, D.DETECTORS[name](tables, TODAY, **options).collect()), key=str)


def test_document_detectors(tables):
    assert run("AP", tables) == [
        ("b1", "AP14-"), ("b2", "AP11-1998060193005"), ("b3", "AP12-19980601130000"),
        ("b4", "AP12-19980601130000"),
    ]
    assert run("OP", tables) == [("b1", "OP21-199806011"), ("b2", "OP21-199806011")]
    assert run("SO", tables) == [("b1", "SO31-199806015")]
    assert run("AR", tables) == [(b, "AR41-199806017") for b in ("b1", "b3", "b6")]
    assert run("BN", tables) == [("b7", "BN-1998060190000"), ("b8", "BN-199806011")]


def test_lookback(tables):
    # Every distinct (item, document) of the lines, cancelled or not.
    assert len(run("AR", tables, lookback_days=31)) == 7


def test_list_detector(tables):
    # b2 lists its one document, b6 both of its two; b3 lists one of two; b1 none.
    assert run("ARNR", tables) == [("b1", f"AR 41, 41-NR-{NOW}"), ("b3", f"AR 41, 42-NR-{NOW}")]
    # As text, the list of one live document differs from a cell without the leading space, but is not longer.
    assert run("ARNR", tables, legacy=True) == run("ARNR", tables)
    assert run("ARNR", tables, count_distinct=True) == run("ARNR", tables)


def test_list_detector_counts_lines(spark, tables):
    lines = tables["receivable_line"].union(spark.createDataFrame([(2, "b2")], "doc_entry bigint, item string"))
    more = tables | {"receivable_line": lines}
    assert "b2" not in dict(run("ARNR", more))
    assert dict(run("ARNR", more, legacy=True))["b2"] == f"AR 42, 42-NR-{NOW}"
    assert "b2" not in dict(run("ARNR", more, legacy=True, count_distinct=True))


def test_level_detectors(tables):
    assert run("DUP", tables) == [("b4", f"DUP-{NOW}"), (None, f"DUP-{NOW}")]
    assert run("PTF", tables) == [("b1", f"PTF-{NOW}"), ("b3", f"PTF-{NOW}")]
    # A NULL key in the read model silences NOT IN.
    assert run("MISSING", tables) == []
    keyed = tables | {"read_model": tables["read_model"].where("booking_id IS NOT NULL")}
    assert run("MISSING", keyed) == [("b7", f"MISSING-{NOW}")]


@pytest.mark.parametrize("keep", ["true", "booking_id IS NOT NULL", "false"])
def test_levels_in_one_pass(tables, keep):
    some = tables | {"read_model": tables["read_model"].where(keep)}
    fused = sorted(map(tuple, D.detect_levels(some, TODAY).collect()), key=str)
    single = [(i, s, n) for n in P.LEVEL for i, s in run(n, some)]
    assert fused == sorted(single, key=str)


def test_fetch_keeps_the_newest_and_counts(tables):
    raw = P.raw_events(tables, TODAY)
    every = latest_per_id(drop_null_ids(raw))
    fetched = P.fetch_events(tables, TODAY)
    assert sorted(fetched.collect()) == sorted(every.collect())
    ids = [r.id for r in fetched.collect()]
    assert len(ids) == len(set(ids)) and None not in ids
    counters = run_metrics(raw, fetched, fetched.limit(0)).first()
    assert (counters.found, counters.null_ids, counters.fetched, counters.to_process) == (raw.count(), 1, len(ids), 0)


def test_counters_are_observed_on_the_way(spark, tables):
    raw = P.raw_events(tables, TODAY)
    every = latest_per_id(drop_null_ids(raw))
    ledger = every.limit(2).select("id", "serial")
    ledger = spark.createDataFrame(ledger.union(ledger).collect(), "id string, serial string")
    left, counters = P.counted_fetch(tables, TODAY, ledger)
    assert counters.first() == run_metrics(raw, every, exclude_processed(every, ledger)).first()
    assert sorted(left.collect()) == sorted(P.fetch_events(tables, TODAY, ledger).collect())


def test_ledger_modes_differ(spark, tables):
    newest = {r.id: r.serial for r in P.fetch_events(tables, TODAY).collect()}
    ledger = spark.createDataFrame([("b3", newest["b3"])], "id string, serial string")
    after = {r.id: r.serial for r in P.fetch_events(tables, TODAY, ledger).collect()}
    assert "b3" not in after
    before = {r.id: r.serial for r in P.fetch_events(tables, TODAY, ledger, "exclude_then_dedupe").collect()}
    assert before["b3"] != newest["b3"]
    assert P.fetch_events(tables, TODAY, limit=2).count() == 2
    with pytest.raises(ValueError):
        P.fetch_events(tables, TODAY, mode="other")


def test_order_of_ties_and_padding(frame):
    early, late = frame([("a", "AP1-1998060193005")], "id string, serial string"), frame(
        [("a", "SO1-19980531235959"), ("b", "SO2-19980601000001")], "id string, serial string"
    )
    events = union_detectors({"AP": early, "SO": late})
    assert {r.id: r.serial for r in latest_per_id(events).collect()} == {"a": "AP1-1998060193005", "b": "SO2-19980601000001"}
    legacy = union_detectors({"AP": early, "SO": late}, legacy=True)
    assert {r.id: r.serial for r in latest_per_id(legacy).collect()}["a"] == "SO1-19980531235959"
    assert [r.id for r in limit_events(events, 1).collect()] == ["a"]
    assert limit_events(events, 0).count() == 3
    tied = union_detectors({n: frame([("a", f"{n}-19980601")], "id string, serial string") for n in ("SO", "AP")})
    assert latest_per_id(tied).first().serial == "AP-19980601"


def test_first_and_exclude(frame):
    events = frame([("a", "s2", 2), ("a", "s1", 1), ("b", "s3", 3)], "id string, serial string, position int")
    assert sorted(map(tuple, first_per_id(events, "position").collect())) == [("a", "s1", 1), ("b", "s3", 3)]
    ledger = frame([("a", "s1"), ("a", "s1"), ("b", "s1")], "id string, serial string")
    assert sorted(r.serial for r in exclude_processed(events, ledger).collect()) == ["s2", "s3"]


def test_doc_list_is_cut_like_the_whole_list(frame):
    lines = [("hot", d) for d in range(700)] + [("hot", 3)] * 5 + [("a", 10), ("a", 9), ("a", 10)]
    counts = doc_counts(frame(lines, "item string, doc_num bigint"))
    for distinct in (False, True):
        got = {r["item"]: r.doc_list for r in doc_list(counts, distinct=distinct).collect()}
        for item in ("hot", "a"):
            docs = sorted(d for i, d in (set(lines) if distinct else lines) if i == item)
            assert got[item] == (" " + ", ".join(map(str, docs)))[:LIST_CHARS]


def test_doc_list_of_null_numbers_and_whole(frame):
    counts = doc_counts(frame([("a", None)] * 600 + [("a", 5)], "item string, doc_num bigint"))
    whole = " " + ", ".join([""] * 600 + ["5"])
    assert doc_list(counts).first().doc_list == whole[:LIST_CHARS]
    assert doc_list(counts, chars=None).first().doc_list == whole


def test_reconcile_matches_pairs(frame):
    import itertools
    import random

    rng = random.Random(2)
    texts = [None, "", " ", "a b", "ab", "c"]
    numbers = [None, "NaN", "0", "1", "1,000", "1000", "x"]
    make = lambda pool: [(f"k{rng.randrange(40)}", rng.choice(pool), rng.choice(pool)) for _ in range(70)] + [(None, "q", "5")]
    schema = "k string, x string, y string"
    squeeze = lambda v: None if v is None else v.replace(" ", "")
    blank = lambda v: not squeeze(v)

    def number(v):
        try:
            return None if v is None or v == "NaN" else float(v.replace(",", ""))
        except ValueError:
            return None

    text_test = lambda a, b: (None not in (a, b) and squeeze(a) != squeeze(b)) or blank(a) != blank(b)

    def number_test(a, b):
        a, b = number(a), number(b)
        return (None not in (a, b) and a != b) or (a not in (None, 0.0) and b in (None, 0.0))

    for pool, reconcile, test in ((texts, reconcile_text, text_test), (numbers, reconcile_numeric, number_test)):
        left, right = make(pool), make(pool)
        pairs = {a[0] for a, b in itertools.product(left, right) if a[0] is not None and a[0] == b[0] and (test(a[1], b[1]) or test(a[2], b[2]))}
        got = reconcile(frame(left, schema), frame(right, schema), "k", "k", [("x", "x"), ("y", "y")])
        assert sorted(r.id for r in got.collect()) == sorted(pairs)


def test_verified_but_absent(frame):
    pod = frame([("1", "Verified"), ("2", "ForAdvanceBilling"), ("3", "x" * 99 + "Verified"), ("4", "Verified")], "booking_id string, status_detail string")
    side = frame([("1",), ("2",), ("3",)], "booking_id string")
    gap = frame([("9",), (None,)], "booking_id string")
    assert sorted(r.id for r in detect_bvnr(pod, side, gap.where("booking_id IS NOT NULL"), TODAY).collect()) == ["1", "2"]
    assert detect_bvnr(pod, side, gap, TODAY).count() == 0
    assert [r.id for r in detect_tvnr(pod, side, gap, TODAY).collect()] == ["1"]
