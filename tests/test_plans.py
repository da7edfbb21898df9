"""What the plans must look like: equi-joins only, ranges that reach the scan, narrow reads, bounded groups."""

import pytest

from tidemark.operators.aggregates import doc_counts, doc_list
from tidemark.operators.filters import changed_on
from tidemark.operators.joins import contains_join, multivalue_join, not_in
from tidemark.plans import detectors as D, fetch as P
from tidemark.plans.booking_view import build_booking_view
from tidemark.schemas import TABLES
from tidemark.sources.tables import TableConfig, read_tables


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("plans")
    from workload.roles import POD_COLUMNS, PLAIN_POD, tables as roles

    given = roles(spark, "/root/testdata/sf0.001")
    for name in TABLES:
        spark.createDataFrame([], TABLES[name]).write.parquet(f"{root}/{name}")
    given["pod"].limit(0).write.parquet(f"{root}/pod")
    found = read_tables(spark, TableConfig(root=str(root)), *TABLES, "pod")
    assert set(PLAIN_POD) <= set(POD_COLUMNS)
    return found


@pytest.fixture(autouse=True)
def no_broadcast_by_size(spark):
    # As at scale, where no table is small enough.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    # Print pushed filters in full.
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def equi_only(df):
    text = plan(df)
    for operator in ("BroadcastNestedLoopJoin", "CartesianProduct", "BroadcastExchange", "BatchEvalPython", "ArrowEvalPython"):
        assert operator not in text, operator
    return text


@pytest.mark.parametrize("name", D.DETECTORS)
@pytest.mark.parametrize("latest", [False, True])
def test_detectors_use_equi_joins(tables, name, latest):
    equi_only(D.DETECTORS[name](tables, "1998-06-01", latest=latest))


def test_fetch_uses_equi_joins(tables):
    equi_only(P.fetch_events(tables, "1998-06-01"))
    equi_only(build_booking_view(tables, "1998-06-01"))


def test_change_range_reaches_the_scan(tables):
    text = plan(changed_on(tables["payable_head"], "1998-06-01", 30))
    assert "GreaterThanOrEqual(create_date,1998-05-02)" in text and "LessThan(update_date,1998-06-02)" in text


def test_narrow_reads(tables):
    text = plan(D.detect_dup(tables, "1998-06-01"))
    assert "ReadSchema: struct<booking_id:string>" in text
    text = plan(D.detect_levels(tables, "1998-06-01"))
    assert "ReadSchema: struct<booking_id:string,ptf_no:string>" in text


def test_null_aware_anti_join_stays_a_shuffle(tables):
    text = plan(not_in(tables["pod"].select("booking_id"), "booking_id", tables["read_model"], "booking_id"))
    assert "SortMergeJoin" in text and "LeftAnti" in text


def test_document_lists_are_cut_before_the_shuffle(tables):
    text = plan(doc_list(doc_counts(tables["receivable_line"].withColumnRenamed("doc_entry", "doc_num"))))
    assert text.count("WindowGroupLimit") == 2


def test_newest_event_is_combined_on_the_map_side(tables):
    text = plan(P.latest_per_id(P.raw_events(tables, "1998-06-01")))
    assert "partial_min" in text.split("Exchange hashpartitioning(id", 1)[1]


def test_substring_and_token_joins(tables):
    equi_only(contains_join(tables["tp"], "pv_no", tables["payable_head"], "pv_no"))
    head = D.changed_heads(tables["payable_head"], "AP", "1998-06-01", 0)
    text = equi_only(multivalue_join(head, tables["payable_line"], tables["tp"]))
    # One join on the keys and one of heads with lines; the four alternatives share the former.
    assert text.count("SortMergeJoin") == 2
