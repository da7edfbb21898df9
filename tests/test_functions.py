from datetime import date

from pyspark.sql import functions as F

from tidemark.functions import metrics as M, text as X
from tidemark.functions.clock import Clock
from tidemark.functions.serial import legacy_stamp, serial_stamp


def values(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_text_rules(frame):
    df = frame([(None,), ("",), ("  ",), (" a , b,a ",), ("x",)], "c string")
    got = values(df, X.is_blank(F.col("c")), X.csv_size(F.col("c")), X.tokens(F.col("c")), X.csv_contains(F.col("c"), F.lit("a")))
    assert got == [
        (True, 0, None, False),
        (True, 1, [""], False),
        (True, 1, [""], False),
        (False, 3, ["a", "b", "a"], True),
        (False, 1, ["x"], False),
    ]


def test_tokens_keep_digits(frame):
    # The position of a token must not be taken for characters to trim.
    df = frame([("510, 521,532",)], "c string")
    assert values(df, X.tokens(F.col("c"))) == [(["510", "521", "532"],)]


def test_concat_takes_null_as_empty(frame):
    assert values(frame([(None, 7)], "a string, b int"), X.concat_text("AP", F.col("a"), "-", F.col("b"))) == [("AP-7",)]


def test_numbers_and_sentinels(frame):
    df = frame([("1,234.5",), ("NaN",), ("",), ("x",), (None,), ("0",)], "c string")
    assert values(df, X.parse_number(F.col("c"))) == [(1234.5,), (None,), (None,), (None,), (None,), (0.0,)]
    assert values(df.limit(2), X.scrub_sentinel(F.col("c"))) == [("1,234.5",), (None,)]


def test_blank_date(frame):
    df = frame([(None,), (date(1900, 1, 1),), (date(1998, 1, 1),)], "d date")
    assert values(df, X.is_blank_date(F.col("d"))) == [(True,), (True,), (False,)]


def test_stamps(frame):
    df = frame([("AP1-1998060193005",), ("AR 1, 2-NR-19980601130509",), ("BN-19980601",), ("X-",), ("7",)], "s string")
    assert [int(r[0]) for r in values(df, serial_stamp(F.col("s")))] == [19980601093005, 19980601130509, 19980601000000, -1, 7]
    assert [int(r[0]) for r in values(df, legacy_stamp(F.col("s")))] == [1998060193005, 19980601130509, 19980601, -1, 7]


def test_clock(frame):
    df = frame([(1,)], "x int")
    at = "1998-06-01 13:05:09"
    assert values(df, Clock(at).stamp(), Clock(at, legacy_12h=True).stamp(), Clock("1998-06-01").stamp()) == [
        ("19980601130509", "19980601010509", "19980601000000")
    ]


def test_payment_status_boundaries(frame):
    df = frame([(-14,), (-13,), (-1,), (0,), (None,)], "d int")
    status = M.payment_status(F.col("d"))
    assert values(df, status, M.carrier_penalty(status, F.col("d"))) == [
        ("Lost", 0), ("Late", -2600), ("Late", -200), ("Ontime", 0), ("", 0),
    ]


def test_vat(frame):
    df = frame([(None,), ("Y",), ("N",), ("X",)], "v string")
    assert values(df, M.net_of_vat(F.lit(112.0), F.col("v"))) == [(112.0,), (112.0,), (112.0 / 1.12,), (None,)]


def test_dates_and_penalties(frame):
    rows = [
        (date(1998, 5, 1), date(1998, 5, 11), 1, 3, None),
        (date(1998, 5, 1), None, 0, 3, date(1998, 5, 2)),
        (None, date(1998, 5, 11), 0, 3, None),
    ]
    df = frame(rows, "delivery date, received date, waived int, terms int, actual date")
    c = F.col
    overdue = M.client_sub_overdue(c("delivery"), c("received"), c("waived"), c("terms"))
    deadline = M.submit_deadline(c("delivery"), c("terms"))
    left = M.overdue_days(c("actual"), deadline, F.lit(0), Clock("1998-06-01"))
    assert values(df, overdue, M.client_penalty(overdue), deadline, left) == [
        (-6, -1200, date(1998, 5, 4), -28), (0, 0, date(1998, 5, 4), 2), (0, 0, None, 0),
    ]
    lost = M.lost_penalty(F.lit("Lost"), c("actual"), c("delivery"), F.lit(10.0))
    assert values(df.limit(1), lost, M.lost_penalty(F.lit("Lost"), c("actual"), c("delivery"), F.lit(None))) == [(-20.0, 0.0)]
    assert values(df.limit(1), M.submission_status(c("actual")), M.flag_or_n(F.lit(" ")), M.weekday_or_stored(F.lit(""), c("delivery"))) == [
        ("PENDING", "N", "Friday")
    ]
