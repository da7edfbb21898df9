import random

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from tidemark.operators import joins as J

HEAD = "doc_entry bigint, pv_no string, serial string"
ROW = "booking_id string, pv_no string"


def toks(cell):
    return [t.strip(" ") for t in cell.split(",")]


def disjunction(head, lines, rows):
    found = set()
    for entry, pv, serial in head:
        items = {i for e, i in lines if e == entry}
        for booking, cell in rows:
            if booking is None:
                continue
            same = pv is not None and cell is not None and (
                cell.rstrip(" ") == pv.rstrip(" ") or pv.rstrip(" ") in toks(cell) or cell.rstrip(" ") in toks(pv)
            )
            if same or booking in items:
                found.add((booking, serial))
    return found


def test_multivalue_join_is_the_disjunction(frame):
    rng = random.Random(5)
    cells = [None, "", " ", "A", "B ", "A, B", " A ,C", "B,,C", "C , D", "A B", "A,A"]
    head = [(i, rng.choice(cells), f"AP{i}-1998060112000{i % 10}") for i in range(40)]
    rows = [(rng.choice([None, f"b{i}"]), rng.choice(cells)) for i in range(60)]
    lines = [(rng.randrange(50), rng.choice([None, *(f"b{i}" for i in range(60))])) for _ in range(60)]
    got = J.multivalue_join(frame(head, HEAD), frame(lines, "doc_entry bigint, item string"), frame(rows, ROW))
    assert sorted(map(tuple, got.collect())) == sorted(disjunction(head, lines, rows))


def test_csv_ref_join_ignores_unreadable_tokens(frame):
    rows = frame(
        [("a", " 7 , x", None), ("b", None, "8,7"), (" ", "7", "7"), (None, "7", None), ("c", "", "70")],
        "booking_id string, doc_refs string, paid_refs string",
    )
    docs = frame([(7, "OP7"), (8, "OP8"), (None, "OP-")], "doc_num bigint, serial string")
    got = J.csv_ref_join(rows, docs, ["doc_refs", "paid_refs"]).collect()
    assert sorted(map(tuple, got)) == [("a", "OP7"), ("b", "OP7"), ("b", "OP8")]


@pytest.mark.parametrize(
    "keys, kept", [(["a"], ["b"]), (["a", None], []), ([], ["a", "b", None]), ([None], [])]
)
def test_not_in(frame, keys, kept):
    df = frame([("a",), ("b",), (None,)], "k string")
    other = frame([(k,) for k in keys], "o string")
    assert sorted([r.k for r in J.not_in(df, "k", other, "o").collect()], key=str) == sorted(kept, key=str)


def test_not_exists_keeps_null(frame):
    df, other = frame([("a",), (None,)], "k string"), frame([("a",), (None,)], "o string")
    assert [r.k for r in J.not_exists(df, "k", other, "o").collect()] == [None]


def test_contains_join_is_exact(frame):
    rng = random.Random(11)
    word = lambda n: "".join(rng.choice("ab%_") for _ in range(n))
    cells = [", ".join(word(rng.randrange(1, 30)) for _ in range(rng.randrange(1, 4))) for _ in range(80)] + [None, "", " , "]
    needles = [word(n) for n in (1, 2, 5, 9, 31, 32, 33, 40)] * 2 + ["", " ", None]
    long = cells[3].replace(" ", "").replace(",", "")
    needles += [long, f" {long[1:]} "]
    cells += ["x😀y", "😀", "é, 😀😁z", "\U0001f601"]
    needles += ["😀y", "é😀😁", "\U0001f602"]
    as_frames = frame([(c,) for c in cells], "cell string"), "cell", frame([(n,) for n in needles], "n string"), "n"
    got = J.contains_join(*as_frames)
    assert sorted(r.cell for r in J.contains_join(*as_frames, gram=2).collect()) == sorted(r.cell for r in got.collect())
    hits = {
        c for c in cells if c is not None
        if any(n and n.strip(" ") and n.strip(" ") in c.replace(" ", "").replace(",", "") for n in needles)
    }
    assert sorted(r.cell for r in got.collect()) == sorted(hits)


def test_long_cells_and_needles_with_one_beginning(frame):
    rng, start = random.Random(3), "shared-beginning-of-32-characters"
    long = "".join(rng.choice("abcdef") for _ in range(10_000))
    cells = [long, f"{long}{start}00042", f"{start}99999, {long[:50]}", "none"]
    needles = [f"{start}{k:05}" for k in range(100_000) if k != 99_999] + [long[700:760]]
    got = J.contains_join(frame([(c,) for c in cells], "cell string"), "cell", frame([(n,) for n in needles], "n string"), "n")
    assert sorted(r.cell for r in got.collect()) == sorted(cells[:2])
    grams = frame([(long,)], "t string").select(F.size(J._grams(F.col("t"), F.lit(J.GRAM_CHARS))).alias("n")).first().n
    assert grams <= len(long)


def test_contains_join_without_needles(frame):
    got = J.contains_join(frame([("a",)], "cell string"), "cell", frame([], "n string"), "n")
    assert got.count() == 0


def test_valid_ref_and_unique_key(frame):
    rows = frame([("1", "7"), ("2", "x"), ("3", None), ("4", "9")], "booking_id string, ref string")
    live = frame([(7,), (7,), (None,)], "doc_entry bigint")
    assert sorted((r.booking_id, r.ref) for r in J.valid_ref_or_blank(rows, "ref", live).collect()) == [
        ("1", "7"), ("2", ""), ("3", ""), ("4", ""),
    ]
    assert J.assert_unique_key(rows, "booking_id").count() == 4
    with pytest.raises(SparkRuntimeException):
        J.assert_unique_key(rows.union(rows), "booking_id").collect()


def test_enrich_keeps_fan_out(frame):
    pod = frame([("1", "c", "s")], "booking_id string, client_code string, carrier_code string")
    billing = frame([("1", "b1"), ("1", "b2")], "booking_id string, code string")
    none = frame([], "booking_id string, code string")
    partner = frame([("c", "client"), ("s", "carrier")], "code string, name string")
    got = J.enrich_booking(pod, billing, none, none, partner).select("billing_code", "client_name", "carrier_name")
    assert sorted(map(tuple, got.collect())) == [("b1", "client", "carrier"), ("b2", "client", "carrier")]


def test_payment_chain(frame):
    head = frame([(1, 10), (2, 20)], "doc_entry bigint, doc_num bigint")
    line = frame([(1, 100), (1, 101), (2, 999)], "doc_num bigint, doc_entry bigint")
    payable = frame([(100, 5), (101, None)], "doc_entry bigint, doc_num bigint")
    got = J.payment_to_invoice(head, line, payable).select("pay_num", "doc_num")
    assert sorted(map(tuple, got.collect()), key=str) == [(10, 5), (10, None)]


def test_many_equal_cells_are_paired_in_blocks_and_not_told_apart(frame, monkeypatch):
    monkeypatch.setattr(J, "BLOCK", 3)
    cells = ["", "", "", "a", "a ", "a , b", "b", None, "b,b", "c,a", " "]
    head = [(i, f"s{i}", c) for i, c in enumerate(cells)] + [(90, "s0", "a"), (91, "s1", ""), (92, None, ""), (93, None, "a")]
    rows = [(f"i{i}", c) for i, c in enumerate(cells * 2)] + [("i0", "b"), ("i1", ""), (None, "")]
    line = [(3, "i5"), (3, "i5"), (4, "i4"), (90, "i1"), (7, "i3"), (1, None)]
    tokens = lambda c: [t for t in {t.strip() for t in c.split(",")}]
    alike = lambda h, r: h is not None and r is not None and (h.rstrip(" ") == r.rstrip(" ") or h.rstrip(" ") in tokens(r) or r.rstrip(" ") in tokens(h))
    named = lambda doc, i: any((doc, i) == x for x in line)
    expected = {(i, s) for doc, s, h in head for i, r in rows if i is not None and (alike(h, r) or named(doc, i))}
    frames = frame(head, "doc_entry long, serial string, pv_no string"), frame(line, "doc_entry long, item string"), frame(rows, "booking_id string, pv_no string")
    joined = J.multivalue_join(*frames)
    got = joined.collect()
    assert len(got) == len(set(map(tuple, got))) and set(map(tuple, got)) == expected
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("Union") and "_block" in plan[: plan.index("\n+- Project")] + plan[plan.rindex("\n+- Project") :]
    blank = lambda c: c is not None and not c.strip()
    unblank = {(i, s) for doc, s, h in head for i, r in rows if i is not None and ((alike(h, r) and not blank(h)) or named(doc, i))}
    assert set(map(tuple, J.multivalue_join(*frames, blanks=False).collect())) == unblank
