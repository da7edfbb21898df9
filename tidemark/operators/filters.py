"""Row filters shared by the detectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.clock import Clock, as_clock


def _within(c: Column, clock: Clock, lookback_days: int) -> Column:
    # A half-open range on the bare column, so that it reaches the scan.
    return (c >= F.date_sub(clock.day(), lookback_days)) & (c < F.date_add(clock.day(), 1))


def changed_on(
    df: DataFrame, as_of: Clock | None = None, lookback_days: int = 0, create="create_date", update="update_date"
) -> DataFrame:
    """Rows created or updated on the day, or in the ``lookback_days`` before it."""
    clock = as_clock(as_of)
    return df.where(
        _within(F.col(create), clock, lookback_days) | _within(F.col(update), clock, lookback_days)
    )


def created_on(df: DataFrame, as_of: Clock | None = None, lookback_days: int = 0, create="create_date") -> DataFrame:
    return df.where(_within(F.col(create), as_clock(as_of), lookback_days))


def not_cancelled(df: DataFrame, mode: str = "is_n", flag: str = "cancelled") -> DataFrame:
    """``is_n`` keeps 'N' only, ``not_y`` keeps all codes but 'Y'; NULL flags are dropped by both."""
    if mode not in ("is_n", "not_y"):
        raise ValueError(f"unknown mode {mode!r}")
    return df.where(F.col(flag) == "N" if mode == "is_n" else F.col(flag) != "Y")


def split_locks(df: DataFrame, client: str, group: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Locks kept and locks removed when ``client`` leaves, in one group or in all.

    Only that client's own locks of that group are removed.
    """
    gone = F.col("client") == client
    if group is not None:
        gone = gone & (F.col("grp") == group)
    gone = F.coalesce(gone, F.lit(False))
    return df.where(~gone), df.where(gone)
