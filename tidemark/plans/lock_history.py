"""The lock protocol over a whole request log, or over a batch that continues earlier ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.locks import INFO, clean_ups, lock_holds, registration_intervals, registrations
from tidemark.session import materialize
from tidemark.sources.messages import dispatch, parse_messages, to_requests


def read_requests(log: DataFrame) -> DataFrame:
    """Usable requests of a message log, written out: each step of the protocol reads them again."""
    valid, _ = parse_messages(log)
    usable, _ = to_requests(dispatch(valid))
    return materialize(usable)


def rejected_messages(log: DataFrame) -> DataFrame:
    """What ``read_requests`` leaves out of a message log: ``event_id``, ``ts``, ``reason``."""
    valid, malformed = parse_messages(log)
    _, invalid = to_requests(dispatch(valid))
    return malformed.select("event_id", "ts", F.lit("malformed").alias("reason")).unionByName(
        invalid.select("at.event_id", "at.ts", F.lit("invalid").alias("reason"))
    )


def lock_history(requests: DataFrame, open_stints: DataFrame | None = None, parts: int | None = None) -> DataFrame:
    """Every stint with its grant; ``open_stints`` are earlier results whose ``leave`` is still unknown."""
    entries = registrations(requests).select("client", "grp", "row_id", "at", "user_id", "user_name")
    if open_stints is not None:
        earlier = open_stints.select(*INFO, "grp", "row_id", F.col("enter").alias("at"), "granted_at")
        entries = entries.unionByName(earlier, allowMissingColumns=True)
    # A stint enters and leaves a row once each, and there are no more of them than entries.
    return lock_holds(registration_intervals(entries, clean_ups(requests), parts), parts, entries.select("grp", "row_id"))
