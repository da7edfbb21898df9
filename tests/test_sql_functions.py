"""SQL texts that call the functions by name give what the column expressions give."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import metrics as M, text as X
from tidemark.functions.sql import SCALARS, TABLES, register_functions

DAY = dt.date(1998, 5, 1)
DAYS = [None, dt.date(1900, 1, 1), DAY, DAY + dt.timedelta(13), DAY + dt.timedelta(14), DAY - dt.timedelta(3)]


@pytest.fixture(scope="module", autouse=True)
def registered(spark):
    names = register_functions(spark)
    assert len(names) == len(set(names)) == len(SCALARS) + len(TABLES)
    register_functions(spark)  # a second time replaces them


def same(df, **pairs):
    """Each pair is (SQL text, column expression); both must agree on every row."""
    got = df.select(*[F.expr(sql).alias(n) for n, (sql, _) in pairs.items()]).collect()
    wanted = df.select(*[column.alias(n) for n, (_, column) in pairs.items()]).collect()
    assert got == wanted and got


def test_text(frame):
    c = F.col
    cells = [None, "", "  ", "a", "a, b", " b ,", ",", "1,000", "NaN", "x1", "-2.5", "1e3"]
    df = frame([(x, y) for x in cells for y in [None, "", "a", "b"]], "cell string, v string")
    same(
        df,
        blank=("blank_text(cell)", X.is_blank(c("cell"))),
        has=("cell_has(cell, v)", X.csv_contains(c("cell"), c("v"))),
        number=("number_of(cell)", X.parse_number(c("cell"))),
        flag=("flag_or_n(cell)", M.flag_or_n(c("cell"))),
        weekday=("weekday_or_stored(cell, DATE'1998-05-01')", M.weekday_or_stored(c("cell"), F.lit(DAY))),
    )


def test_metrics(frame):
    c = F.col
    rows = [(a, b, w, k) for a in DAYS for b in DAYS for w in [None, 0, 2] for k in [None, 0, 5]]
    df = frame(rows, "a date, b date, w int, k int")
    as_of = "1998-06-01"
    same(
        df,
        status=("submission_status(a)", M.submission_status(c("a"))),
        overdue=("client_sub_overdue(a, b, w, k)", M.client_sub_overdue(c("a"), c("b"), c("w"), c("k"))),
        penalty=("client_penalty(k - 3)", M.client_penalty(c("k") - 3)),
        deadline=("submit_deadline(a, k)", M.submit_deadline(c("a"), c("k"))),
        days=(f"overdue_days(a, b, w, DATE'{as_of}')", M.overdue_days(c("a"), c("b"), c("w"), as_of)),
    )
    graded = frame([(d, t) for d in [None, 1, 0, -1, -13, -14] for t in [None, 0.0, 8.5]], "d int, t double")
    of = M.payment_status(c("d"), c("t").isNotNull())
    same(
        graded,
        status=("payment_status(d, t IS NOT NULL)", of),
        carrier=("carrier_penalty(payment_status(d, true), d)", M.carrier_penalty(M.payment_status(c("d")), c("d"))),
        lost=("lost_penalty(payment_status(d, t IS NOT NULL), t)", M.lost_penalty(of, c("t"), c("t"), c("t"))),
        total=("total_sub_penalties(d, d, t, t)", M.total_sub_penalties(c("d"), c("d"), c("t"), c("t"))),
        waived=("penalty_waived(t, d)", M.penalty_waived(c("t"), c("d"))),
    )
    codes = frame([(x, s) for x in [None, 112.0] for s in [None, "Y", "N", "X"]], "x double, s string")
    same(codes, net=("net_of_vat(x, s)", M.net_of_vat(c("x"), c("s"))))


def test_tokens_as_a_table(spark, frame):
    frame([(1, "a , b"), (2, ""), (3, None)], "k int, cell string").createOrReplaceTempView("cells_given")
    found = spark.sql("SELECT k, position, token FROM cells_given, LATERAL cell_tokens(cell) ORDER BY k, position").collect()
    assert [tuple(r) for r in found] == [(1, 0, "a"), (1, 1, "b"), (2, 0, "")]


def test_penalties_stay_one_projection(spark, frame):
    """The table function of one row is a projection of its arguments: no join, no shuffle, no Python."""
    spark.range(10).selectExpr("DATE'1998-05-01' AS d", "CAST(id AS INT) AS k").createOrReplaceTempView("few")
    df = spark.sql(
        "SELECT p.* FROM few, LATERAL booking_penalties(d, date_add(d, k), d, 0, k, 0, 0, 1D, 0D, 0.5D, DATE'1998-06-01') p"
    )
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Join", "Exchange", "Python")), plan
    assert df.count() == 10
