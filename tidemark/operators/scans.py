"""Ordered scans that stay balanced however large one key is.

A window over a key runs in one task. So keys with more rows than a task should have are cut into runs of their
order at bounds taken from a sample of their rows; each run is scanned on its own, and what earlier runs contribute
is joined in from their totals. All other keys take the plain window: one shuffle. Fewer than ``parts`` keys can
have more than n / parts of n rows, which bounds what is collected and broadcast here, whatever the data.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window, functions as F, types as T

from tidemark.session import materialize

# Rows of one key that one task always takes, and rows sampled for each run of a longer key.
ROWS_PER_TASK = 100_000
SAMPLES = 16
RUN = "_run"


def _local(op: str, value: Column, window) -> Column:
    if op == "last":
        return F.last(value, ignorenulls=True).over(window)
    return {"max": F.max, "sum": F.sum}[op](value).over(window)


def _total(op: str, value: Column, order: Column, descending: bool) -> Column:
    if op == "last":
        pick = F.min_by if descending else F.max_by
        return pick(value, F.when(value.isNotNull(), order))
    return {"max": F.max, "sum": F.sum}[op](value)


def _combine(op: str, carried: Column, local: Column) -> Column:
    if op == "last":
        return F.coalesce(local, carried)
    if op == "sum":
        return F.coalesce(local, F.lit(0)) + F.coalesce(carried, F.lit(0))
    return F.greatest(local, carried)


def _same(names: list[str]) -> Column:
    """``names`` equal their copies called ``_k_…``; NULL is a key like any other."""
    return reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"_k_{n}")) for n in names], F.lit(True))


def _renamed(keys: list[str]) -> list[Column]:
    return [F.col(k).alias(f"_k_{k}") for k in keys]


def long_keys(df: DataFrame, keys: list[str], parts: int | None = None) -> tuple[list[Row], int]:
    """Keys of ``df`` with too many rows for one task, as rows of the keys and ``_n``, and how many a task takes.

    That is ``ROWS_PER_TASK`` or a fair share of all rows, whichever is more; with ``parts`` given, just the share.
    Fewer than ``parts`` keys can have more than the share.
    """
    least = 1 if parts else ROWS_PER_TASK
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    share = F.greatest(F.ceil(F.coalesce(F.sum("_n"), F.lit(0)) / parts), F.lit(least))
    found = counted.withColumn("_most", counted.agg(share.cast("bigint").alias("most")).scalar()).where("_n > _most").collect()
    return found, found[0]["_most"] if found else 0


def _bounds(df: DataFrame, keys: list[str], order: list[str], found: list[Row], most: int) -> DataFrame:
    """For each long key the places where its runs begin: quantiles of rows chosen by their hash."""
    schema = T.StructType([*[df.schema[k] for k in keys], T.StructField("_n", T.LongType())])
    long = df.sparkSession.createDataFrame([tuple(r[c] for c in [*keys, "_n"]) for r in found], schema)
    long = long.select(*_renamed(keys), (F.ceil(F.col("_n") / most) * SAMPLES).alias("_slots"))
    place, chance = F.struct(*order), F.xxhash64(*order)
    drawn = (
        df.join(F.broadcast(long), _same(keys))
        .groupBy(*[f"_k_{k}" for k in keys], F.pmod(chance, "_slots").alias("_slot"))
        .agg(F.min_by(place, F.xxhash64(F.lit(SAMPLES), *order)).alias("_place"))
    )
    # A key has SAMPLES places for each of its runs.
    sorted_places = drawn.groupBy(*[f"_k_{k}" for k in keys]).agg(F.sort_array(F.collect_list("_place")).alias("_all"))
    begins = F.filter("_all", lambda _, i: (i > 0) & (i % SAMPLES == 0))
    return sorted_places.select(*[f"_k_{k}" for k in keys], begins.alias("_begins"))


def _run_of(place: Column, runs: int) -> Column:
    """The number of bounds at or below ``place``, found by halving; 0 where there are none."""
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(runs.bit_length()))])
    step = lambda at, size: F.when(F.try_element_at("_begins", at + size) <= place, at + size).otherwise(at)
    return F.aggregate(steps, F.lit(0), step)


def scan_before(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    aggregates: dict[str, tuple[str, Column]],
    descending: bool = False,
    parts: int | None = None,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Add, per row, aggregates over the rows of its key strictly before it in ``order``.

    ``aggregates`` maps a new column to ``("max" | "sum" | "last", value)``; ``last`` skips NULLs. With
    ``descending`` the scan runs from the end, so that "before" means following. ``order`` must be total.
    ``sizes`` is a frame whose rows of a key are about as many, for a ``df`` that is dear to count. ``df`` is
    written out only if it has keys to cut.
    """
    names = list(aggregates)
    ops = {n: aggregates[n][0] for n in names}
    found, most = long_keys(sizes if sizes is not None else df, keys, parts)
    prepared = df.withColumns({f"_in_{n}": value for n, (_, value) in aggregates.items()})
    row_order = [F.col(c).desc() if descending else F.col(c).asc() for c in order]
    before = lambda by, rows: Window.partitionBy(*by).orderBy(*rows).rowsBetween(Window.unboundedPreceding, -1)
    if not found:
        window = before(keys, row_order)
        local = {n: _local(ops[n], F.col(f"_in_{n}"), window) for n in names}
        whole = {n: F.coalesce(local[n], F.lit(0)) if ops[n] == "sum" else local[n] for n in names}
        return prepared.withColumns(whole).select(*df.columns, *names)

    prepared = materialize(prepared)
    bounds = _bounds(prepared, keys, order, found, most)
    place = F.struct(*order)
    cut = prepared.join(F.broadcast(bounds), _same(keys), "left")
    cut = cut.withColumn(RUN, _run_of(place, sum(math.ceil(r["_n"] / most) for r in found)))
    totals = cut.where("_begins IS NOT NULL").groupBy(*keys, RUN).agg(
        *[_total(ops[n], F.col(f"_in_{n}"), place, descending).alias(f"_sum_{n}") for n in names]
    )
    run_order = [F.col(RUN).desc() if descending else F.col(RUN).asc()]
    carried = totals.select(
        *_renamed([*keys, RUN]),
        *[_local(ops[n], F.col(f"_sum_{n}"), before(keys, run_order)).alias(f"_carry_{n}") for n in names],
    )
    scanned = cut.drop("_begins", *[f"_k_{k}" for k in keys]).withColumns(
        {f"_here_{n}": _local(ops[n], F.col(f"_in_{n}"), before([*keys, RUN], row_order)) for n in names}
    )
    joined = scanned.join(F.broadcast(carried), _same([*keys, RUN]), "left")
    return joined.withColumns({n: _combine(ops[n], F.col(f"_carry_{n}"), F.col(f"_here_{n}")) for n in names}).select(
        *df.columns, *names
    )


def number_rows(df: DataFrame, order: list[str], name: str = "step", parts: int | None = None) -> DataFrame:
    """Number the rows 1..n in ``order`` without gathering more than a task's share in one task."""
    counted = scan_before(df, [], order, {name: ("sum", F.lit(1).cast("bigint"))}, parts=parts)
    return counted.withColumn(name, F.col(name) + 1)
