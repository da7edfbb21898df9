"""Every query has its SQL, and a selection agrees with it here; the driver compares all of them."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()
CHECKED = [
    "changed_on", "csv_membership", "multivalue_join", "not_in_keys", "contains_join", "doc_list", "detect_op",
    "detect_arnr", "detect_levels", "detect_bpdi", "booking_view", "scalar_functions", "message_requests",
    "fetch_events", "messages_valid", "messages_rejected", "event_file_stream",
]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    return con


def norm(value):
    return round(value, 6) if isinstance(value, float) else value


def test_every_query_has_sql():
    assert set(entry.QUERIES) == set(entry.oracles())


@pytest.mark.parametrize("name", CHECKED)
def test_query_agrees_with_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = Counter(tuple(norm(r[c]) for c in columns) for r in df.collect())
    result = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    wanted = Counter(tuple(norm(row[names.index(c)]) for c in columns) for row in result.fetchall())
    assert sorted(names) == columns
    assert got == wanted and got


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["id", "serial", "detector", "stamp"] and df.count() > 0
