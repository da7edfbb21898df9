"""Queries over all documents and lines: each item on a line of a changed document is among the ids."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.01"
TABLES = "customer supplier part orders lineitem events".split()
ITEMS = """SELECT DISTINCT CAST(l_partkey AS VARCHAR) FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    WHERE CAST(o_orderdate AS DATE) BETWEEN DATE'1998-05-02' AND DATE'1998-06-01'"""


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    return con


@pytest.mark.parametrize(
    "name",
    ["event_file", "exclude_processed", "latest_per_id", "union_distinct_paths", "order_by_stamp", "pending_steps", "detect_so", "process_events"],
)
def test_no_document_is_left_out(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    got = df.collect()
    result = duck.execute(entry.oracle_sql()[name])
    at = [[d[0] for d in result.description].index(c) for c in df.columns]
    assert Counter(map(tuple, got)) == Counter(tuple(row[i] for i in at) for row in result.fetchall())
    # The ledger holds events of every third item.
    items = {i for (i,) in duck.execute(ITEMS).fetchall() if name != "exclude_processed" or int(i) % 3}
    assert items and items <= {row["id"] for row in got}
