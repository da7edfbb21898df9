"""The given tables tell the options of an operator apart: no two variants give one result."""

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.01"


def found(spark, name):
    return frozenset(tuple(row) for row in entry.queries()[name](spark, SF).collect())


@pytest.mark.parametrize(
    "names",
    [
        ("detect_arnr", "detect_arnr_legacy", "detect_arnr_distinct"),
        ("row_disabled_flag", "row_disabled_flag_token"),
        ("not_cancelled_is_n", "not_cancelled_not_y"),
    ],
)
def test_variants_differ(spark, names):
    results = [found(spark, name) for name in names]
    assert all(results) and len(set(results)) == len(names)


def test_both_flags_occur(spark):
    for name in ("row_disabled_flag", "row_disabled_flag_token"):
        assert {flag for _, flag in found(spark, name)} == {"Y", "N"}
