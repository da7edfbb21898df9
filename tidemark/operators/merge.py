"""Merge detector outputs into one event per id."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F

from tidemark.functions.serial import legacy_stamp, serial_stamp
from tidemark.operators.shuffled import shuffled

# The order in which detector outputs are concatenated, which breaks ties between equal stamps.
DETECTOR_ORDER = ["AP", "OP", "SO", "AR", "ARNR", "BN", "DUP", "PTF", "MISSING"]


def detector_rank(detector: Column) -> Column:
    position = F.array_position(F.array(*[F.lit(d) for d in DETECTOR_ORDER]), detector)
    return F.when(position > 0, position).otherwise(len(DETECTOR_ORDER) + 1).cast("int")


def with_stamp(events: DataFrame, legacy: bool = False) -> DataFrame:
    stamp = legacy_stamp if legacy else serial_stamp
    return events.withColumn("stamp", stamp(F.col("serial")))


def union_detectors(outputs: dict[str, DataFrame], legacy: bool = False) -> DataFrame:
    """All events with the name of their detector and their stamp."""
    tagged = [
        df.select("id", "serial", F.lit(name).alias("detector")) for name, df in outputs.items()
    ]
    return with_stamp(reduce(DataFrame.unionByName, tagged), legacy)


def newest_first() -> list[Column]:
    """A total order: newest stamp, then detector, then serial and id."""
    return [F.col("stamp").desc(), detector_rank(F.col("detector")).asc(), F.col("serial").asc(), F.col("id").asc()]


def order_by_stamp(events: DataFrame) -> DataFrame:
    return events.orderBy(*newest_first())


def with_position(events: DataFrame) -> DataFrame:
    """``events`` in order, with ``position``: larger for each later one, not without gaps. No task sees all events."""
    return order_by_stamp(events).withColumn("position", F.monotonically_increasing_id())


def limit_events(events: DataFrame, n: int | None) -> DataFrame:
    """The first ``n`` events in order; no trim for None or 0."""
    return order_by_stamp(events).limit(n) if n else events


def pick_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key by ``order`` (ascending), as an aggregate.

    Unlike a ranking window, the aggregate combines on the map side, so a large key costs one row per task.
    """
    rest = [c for c in df.columns if c not in keys]
    ranked = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], F.struct(*rest).alias("row"))
    return df.groupBy(*keys).agg(F.min(ranked).alias("_first")).select(*keys, "_first.row.*").select(*df.columns)


def latest_per_id(events: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The newest event of each id (or of each of ``keys``)."""
    order = [-F.col("stamp"), F.col("serial")]
    if "detector" in events.columns:
        order.insert(1, detector_rank(F.col("detector")))
    return pick_first(events, keys or ["id"], order)


def first_per_id(events: DataFrame, arrival: str) -> DataFrame:
    """The first event of each id in arrival order."""
    return pick_first(events, ["id"], [F.col(arrival), F.col("serial")])


def exclude_processed(events: DataFrame, ledger: DataFrame) -> DataFrame:
    """Events whose (id, serial) is not in the ledger."""
    return events.join(shuffled(ledger.select("id", "serial").distinct()), ["id", "serial"], "left_anti").select(
        *events.columns
    )


def drop_null_ids(events: DataFrame) -> DataFrame:
    return events.where(F.col("id").isNotNull())


def run_metrics(raw: DataFrame, fetched: DataFrame, to_process: DataFrame) -> DataFrame:
    """One row of counters: events found, events without an id, ids fetched, ids left to process."""
    kinds = [("found", raw), ("fetched", fetched), ("to_process", to_process)]
    rows = reduce(DataFrame.unionByName, [df.select("id", F.lit(kind).alias("kind")) for kind, df in kinds])
    count = lambda test: F.count(F.when(test, 1))
    return rows.agg(
        count(F.col("kind") == "found").alias("found"),
        count((F.col("kind") == "found") & F.col("id").isNull()).alias("null_ids"),
        count(F.col("kind") == "fetched").alias("fetched"),
        count(F.col("kind") == "to_process").alias("to_process"),
    )


def observed(events: DataFrame) -> tuple[DataFrame, Observation]:
    """``events``, and their number and that of those without an id, counted on the way as whoever reads them does so."""
    seen = Observation()
    without = F.count(F.when(F.col("id").isNull(), 1))
    return events.observe(seen, F.count(F.lit(1)).alias("found"), without.alias("null_ids")), seen
