"""Signed changes of tables, and joins that follow from them.

A change is a row with a ``weight``: 1 for a row that arrives, -1 for one that leaves; an update is one of each. A store keeps one
table's changes by batch, dealt by its key into buckets, so that a batch reads the buckets that its own keys fall into and
nothing else. A batch that is run again writes over itself, and what it reads of earlier ones is as before.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.operators.shuffled import shuffled
from tidemark.session import materialize

WEIGHT = "weight"


def weighted(rows: DataFrame) -> DataFrame:
    """``rows`` with a weight, 1 if they have none."""
    return rows if WEIGHT in rows.columns else rows.withColumn(WEIGHT, F.lit(1).cast("bigint"))


def net(rows: DataFrame) -> DataFrame:
    """Each distinct row with the sum of its weights; rows that came to nothing are left out."""
    keys = [c for c in rows.columns if c != WEIGHT]
    return rows.groupBy(*keys).agg(F.sum(WEIGHT).alias(WEIGHT)).where(F.col(WEIGHT) != 0)


@dataclass(frozen=True)
class Store:
    """The changes of one table with the columns of ``ddl``, by batch and by bucket of ``keys``."""

    spark: SparkSession
    root: str
    ddl: str
    keys: tuple[str, ...]
    buckets: int = 32

    @property
    def columns(self) -> list[str]:
        return self._schema().names[:-3]

    def _schema(self) -> T.StructType:
        return T.DataType.fromDDL(f"{self.ddl}, {WEIGHT} bigint, batch bigint, bucket int")

    def _bucket(self) -> Column:
        return F.pmod(F.hash(*self.keys), F.lit(self.buckets))

    def add(self, rows: DataFrame, batch: int) -> None:
        """Write a batch's changes; rows with a NULL key can't be asked for and are left out."""
        known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in self.keys])
        dealt = rows.select(*self.columns, F.col(WEIGHT).cast("bigint").alias(WEIGHT)).where(known).withColumn("bucket", self._bucket())
        # Files by bucket, however many rows one key has: large buckets stay several files.
        dealt.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/batch={batch}")

    def _log(self, batch: int | None = None) -> DataFrame:
        """All changes, or one batch's; listing a batch's folder does not depend on how many there are."""
        folder = self.root if batch is None else f"{self.root}/batch={batch}"
        try:
            return self.spark.read.schema(self._schema()).option("basePath", self.root).parquet(folder)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self._schema())

    def touched(self, batch: int) -> list[int]:
        """Buckets that a batch's rows fall into, as its files tell."""
        return sorted({int(m[1]) for f in self._log(batch).inputFiles() if (m := re.search(r"/bucket=(\d+)/", f))})

    def of(self, batch: int) -> DataFrame:
        """A batch's own changes."""
        return self._log(batch).select(*self.columns, WEIGHT)

    def until(self, batch: int | None = None) -> DataFrame:
        """All changes up to a batch, or all."""
        log = self._log()
        return (log if batch is None else log.where(F.col("batch") <= batch)).select(*self.columns, WEIGHT)

    def near(self, batch: int, buckets: list[int]) -> DataFrame:
        """Changes up to ``batch`` in ``buckets``, with their batch: all that a join on this store's keys needs."""
        rows = self._log().where((F.col("batch") <= batch) & F.col("bucket").isin(buckets) if buckets else F.lit(False))
        return rows.select(*self.columns, WEIGHT, "batch")

    def at(self, batch: int, keys: DataFrame, buckets: list[int]) -> DataFrame:
        """Changes up to ``batch`` of the rows with one of ``keys``, read from ``buckets`` only, with their batch.

        ``keys`` have this store's key columns; they fall into ``buckets``.
        """
        return self.near(batch, buckets).join(shuffled(keys.select(*self.keys).distinct()), list(self.keys), "left_semi")


def union(parts: list[DataFrame]) -> DataFrame | None:
    return reduce(DataFrame.unionByName, parts) if parts else None


def _product(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    joined = left.withColumnRenamed(WEIGHT, "_left").join(shuffled(right.withColumnRenamed(WEIGHT, "_right")), keys)
    return joined.withColumn(WEIGHT, F.col("_left") * F.col("_right")).drop("_left", "_right")


def joined_change(left: Store, right: Store, batch: int, in_left: bool, in_right: bool) -> DataFrame | None:
    """How a batch changes ``left`` join ``right`` on their key: new rows meet all of the other side, old ones its new rows.

    Both stores hold the batch already; ``in_left`` and ``in_right`` tell which it changes.
    """
    parts, keys = [], list(left.keys)
    if in_left:
        mine = left.of(batch)
        parts.append(_product(mine, right.near(batch, left.touched(batch)).drop("batch"), keys))
    if in_right:
        mine = right.of(batch)
        parts.append(_product(left.near(batch - 1, right.touched(batch)).drop("batch"), mine, keys))
    return union(parts)


def _newest(events: Store, batch: int, keys: DataFrame, buckets: list[int]) -> DataFrame:
    """The serial of each key's newest event before a batch (``was``) and with it (``now``), NULL where none is live.

    One pass for both, so that a task sorts and groups a key's events once.
    """
    before = F.when(F.col("batch") < batch, F.col(WEIGHT))
    live = events.at(batch, keys, buckets).groupBy(*events.columns).agg(F.sum(before).alias("_was"), F.sum(WEIGHT).alias("_now"))
    ranked = F.struct((-F.col("stamp")).alias("rank"), "serial")
    first = [F.min(F.when(F.col(f"_{name}") > 0, ranked)).getField("serial").alias(name) for name in ("was", "now")]
    return live.groupBy(*events.keys).agg(*first)


def newest_join_change(events: Store, rows: Store, batch: int, in_events: bool, in_rows: bool) -> DataFrame | None:
    """How a batch changes the join of each key's newest event (``serial``, ``stamp``) with the key's rows (``id``).

    A key whose newest event becomes another one takes back what it gave; all others give to their new rows only. So a key of
    very many events and rows costs its rows when a newer event comes, and nothing while none does.
    """
    keys, parts, changed = list(events.keys), [], None
    if in_events:
        mine, buckets = events.of(batch), events.touched(batch)
        changed = materialize(_newest(events, batch, mine, buckets).where(~F.col("was").eqNullSafe(F.col("now"))))
        for name, n, sign in (("was", batch - 1, -1), ("now", batch, 1)):
            given = changed.where(F.col(name).isNotNull()).select(*keys, F.col(name).alias("serial"), F.lit(sign).cast("bigint").alias(WEIGHT))
            parts.append(_product(given, rows.near(n, buckets).drop("batch"), keys))
    if in_rows:
        mine = rows.of(batch)
        still = _newest(events, batch, mine, rows.touched(batch)).where(F.col("now").isNotNull())
        still = still.select(*keys, F.col("now").alias("serial"), F.lit(1).cast("bigint").alias(WEIGHT))
        if changed is not None:
            still = still.join(shuffled(changed), keys, "left_anti")
        parts.append(_product(still, mine, keys))
    found = union(parts)
    return None if found is None else found.select("id", "serial", WEIGHT)
