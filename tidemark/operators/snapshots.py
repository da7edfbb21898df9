"""What is still pending after each processed event."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.operators.merge import detector_rank
from tidemark.operators.scans import number_rows


def pending_snapshots(
    events: DataFrame, order: list[str] | None = None, top_n: int = 0, parts: int | None = None
) -> DataFrame:
    """One row per step with the number of events pending before it, and a last row with none.

    The whole pending list of every step would be quadratic; ``top_n`` adds the next ids only, the step's own
    id first. Steps are cut into blocks of ids, each with the first ``top_n`` of the next block copied in, so
    no task sees more than a block.
    """
    if order is None:
        events = events.withColumns({"_newest": -F.col("stamp"), "_rank": detector_rank(F.col("detector"))})
        order = ["_newest", "_rank", "serial", "id"]
    numbered = number_rows(events.select("id", *[c for c in order if c != "id"]), order, parts=parts)
    numbered = numbered.select("step", "id")
    total = numbered.agg(F.coalesce(F.max("step"), F.lit(0)).cast("bigint")).scalar()
    last = events.sparkSession.range(1).select((total + 1).alias("step"), F.lit(None).cast("string").alias("id"))
    steps = numbered.unionByName(last).withColumn("pending", total - F.col("step") + 1)
    if not top_n:
        return steps

    size = max(top_n, 10_000)
    block = F.floor((F.col("step") - 1) / size).cast("bigint")
    own = steps.withColumns({"_block": block, "_own": F.lit(True)})
    halo = own.where((F.col("_block") > 0) & (F.col("step") - F.col("_block") * size <= top_n))
    halo = halo.withColumns({"_block": F.col("_block") - 1, "_own": F.lit(False)})
    ahead = Window.partitionBy("_block").orderBy("step").rowsBetween(0, top_n - 1)
    listed = own.unionByName(halo).withColumn("pending_ids", F.collect_list("id").over(ahead))
    return listed.where("_own").select("step", "id", "pending", "pending_ids")
