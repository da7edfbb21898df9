"""Find keys whose copies of a value disagree between two tables.

A pair of rows disagrees on a column exactly when the two sides' values of the key are not all one value, or
one side has a value where the other has none. Both are facts about per-key minima, maxima and flags, so each
side is reduced to one row per key before the join and a key with very many rows never forms pairs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.text import parse_number, without_spaces


def _facts(df: DataFrame, key: str, side: str, value: dict[str, Column], gap: dict[str, Column]) -> DataFrame:
    aggregates = []
    for name, v in value.items():
        aggregates += [
            F.min(v).alias(f"{side}_{name}_min"),
            F.max(v).alias(f"{side}_{name}_max"),
            F.max(gap[name]).alias(f"{side}_{name}_gap"),
        ]
        aggregates.append(F.max(v.isNotNull() & ~gap[name]).alias(f"{side}_{name}_set"))
    return df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("id")).agg(*aggregates)


def _unequal(n: int) -> Column:
    """False when a side has no value: NULL bounds make the comparison NULL."""
    differ = (F.col(f"a_{n}_min") != F.col(f"b_{n}_max")) | (F.col(f"a_{n}_max") != F.col(f"b_{n}_min"))
    return F.coalesce(differ, F.lit(False))


def _ids(a: DataFrame, b: DataFrame, tests: list[Column]) -> DataFrame:
    return a.join(b, "id").where(reduce(lambda x, y: x | y, tests)).select("id")


def reconcile_text(a: DataFrame, b: DataFrame, a_key: str, b_key: str, pairs: list[tuple[str, str]]) -> DataFrame:
    """Ids where some text pair differs ignoring spaces, or is blank on one side only."""

    def facts(df: DataFrame, key: str, side: str, columns: list[str]) -> DataFrame:
        squeezed = [F.nullif(without_spaces(F.col(c)), F.lit("")) for c in columns]
        value = {str(i): v for i, v in enumerate(squeezed)}
        return _facts(df, key, side, value, {n: v.isNull() for n, v in value.items()})

    left = facts(a, a_key, "a", [p[0] for p in pairs])
    right = facts(b, b_key, "b", [p[1] for p in pairs])
    one_sided = lambda i: (F.col(f"a_{i}_set") & F.col(f"b_{i}_gap")) | (F.col(f"b_{i}_set") & F.col(f"a_{i}_gap"))
    return _ids(left, right, [_unequal(i) | one_sided(i) for i in range(len(pairs))])


def reconcile_numeric(
    a: DataFrame, b: DataFrame, a_key: str, b_key: str, pairs: list[tuple[str, str]]
) -> DataFrame:
    """Ids where some numeric pair differs, or ``a`` has a non-zero number where ``b`` has none or zero."""

    def facts(df: DataFrame, key: str, side: str, columns: list[str]) -> DataFrame:
        value = {str(i): parse_number(F.col(c)) for i, c in enumerate(columns)}
        return _facts(df, key, side, value, {n: v.isNull() | (v == 0) for n, v in value.items()})

    left = facts(a, a_key, "a", [p[0] for p in pairs])
    right = facts(b, b_key, "b", [p[1] for p in pairs])
    return _ids(
        left,
        right,
        [_unequal(i) | (F.col(f"a_{i}_set") & F.col(f"b_{i}_gap")) for i in range(len(pairs))],
    )
