"""Sides of joins that grow with the input."""

from __future__ import annotations

from pyspark.sql import DataFrame


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that shuffles and sorts, and is never broadcast.

    The planner guesses a side's size from its compressed files. Rows with long cells, and keys or grams taken from them, are many
    times that, and a broadcast gathers all of them in the driver.
    """
    return df.hint("merge")
