"""The read model as a table bucketed by its key, so that joins and groups on the key need no shuffle of it.

Each bucket's rows are in a partition ``<bucket>-<version>``. An upsert writes the buckets it touches anew, as partitions
of the next version, and then sets the table's ``tidemark.done`` property: until that one change of metadata readers see the old
partitions, and a write that fails leaves nothing that a reader looks at. Partitions that no reader looks at are dropped
with their files when the next write starts, so a reader has a whole write's time to end.

What an upsert writes follows the touched buckets and not the ids: for many small polls ``ReadModel`` writes less, for a model that
is read by key over and over this one shuffles less. All rows of one key are in one bucket; rows without a key, which only ``create``
brings, are kept apart from the buckets as they come.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.session import materialize

UNKEYED = "none"


@dataclass(frozen=True)
class BucketedModel:
    """Columns of ``schema`` in the managed table ``table``; one writer at a time.

    ``buckets`` is fixed when the table is made: choose it so that a bucket fits into a task.
    """

    spark: SparkSession
    table: str
    key: str
    schema: T.StructType
    buckets: int = 64

    def _quoted(self, name: str) -> str:
        return "`" + name.replace("`", "``") + "`"

    def _columns(self) -> list[Column]:
        return [F.col(self._quoted(name)) for name in self.schema.names]

    def _property(self, name: str) -> int:
        return int(self.spark.sql(f"SHOW TBLPROPERTIES {self.table} ('tidemark.{name}')").first()["value"])

    def _set(self, name: str, value: int) -> None:
        self.spark.sql(f"ALTER TABLE {self.table} SET TBLPROPERTIES ('tidemark.{name}' = '{value}')")

    def _open(self) -> None:
        columns = ", ".join(f"{self._quoted(f.name)} {f.dataType.simpleString()}" for f in self.schema.fields)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} ({columns}, _slot STRING) USING parquet PARTITIONED BY (_slot) "
            f"CLUSTERED BY ({self._quoted(self.key)}) INTO {self.buckets} BUCKETS TBLPROPERTIES "
            f"('tidemark.done' = '0', 'tidemark.next' = '1', 'tidemark.start' = '0', 'tidemark.buckets' = '{self.buckets}')"
        )
        if self._property("buckets") != self.buckets:
            raise ValueError(f"{self.table} has {self._property('buckets')} buckets, not {self.buckets}")

    def _slots(self) -> dict[str, list[int]]:
        """Versions of each bucket, at most a few; the catalog's list of partitions, whatever the rows."""
        found: dict[str, list[int]] = {}
        for row in self.spark.sql(f"SHOW PARTITIONS {self.table}").collect():
            bucket, version = row["partition"].removeprefix("_slot=").rsplit("-", 1)
            found.setdefault(bucket, []).append(int(version))
        return found

    def _live(self) -> dict[str, str]:
        """The partition that holds each bucket's rows as of the last finished write."""
        done, start = self._property("done"), self._property("start")
        newest = {b: max((v for v in versions if start <= v <= done), default=None) for b, versions in self._slots().items()}
        return {b: f"{b}-{v}" for b, v in newest.items() if v is not None}

    def _of(self, slots: list[str]) -> DataFrame:
        rows = self.spark.table(self.table)
        rows = rows.where(F.col("_slot").isin(slots)) if slots else rows.where(F.lit(False))
        return rows.select(*self._columns())

    def read(self) -> DataFrame:
        """The rows as of now, partitioned by the key."""
        return self._of(sorted(self._live().values()))

    def keyed(self) -> DataFrame:
        """The rows that have a key."""
        return self._of(sorted(slot for bucket, slot in self._live().items() if bucket != UNKEYED))

    def _partitions(self, slots: list[str]) -> list[str]:
        return [f"PARTITION (_slot = '{slot}')" for slot in slots]

    def _begin(self) -> int:
        """Drop what no reader looks at, and take a version that no write has had, be it one that failed."""
        live = set(self._live().values())
        dead = [f"{b}-{v}" for b, versions in self._slots().items() for v in versions if f"{b}-{v}" not in live]
        if dead:
            self.spark.sql(f"ALTER TABLE {self.table} DROP IF EXISTS {', '.join(self._partitions(dead))}")
        version = self._property("next")
        self._set("next", version + 1)
        return version

    def _bucket(self, key: Column) -> Column:
        # As Spark itself deals rows to buckets.
        return F.pmod(F.hash(key), F.lit(self.buckets)).cast("string")

    def _write(self, rows: DataFrame, version: int) -> None:
        key = F.col(self.key)
        bucket = F.when(key.isNull(), UNKEYED).otherwise(self._bucket(key))
        slot = F.concat_ws("-", bucket, F.lit(str(version))).alias("_slot")
        rows.select(*self._columns(), slot).write.insertInto(self.table)

    def _spread(self, rows: DataFrame) -> DataFrame:
        return rows.repartition(self.buckets, self.key)

    def create(self, rows: DataFrame) -> None:
        """Replace everything."""
        self._open()
        version = self._begin()
        rows = rows.select(*self._columns())
        known = F.col(self.key).isNotNull()
        self._write(self._spread(rows.where(known)).unionByName(rows.where(~known)), version)
        self.spark.sql(
            f"ALTER TABLE {self.table} SET TBLPROPERTIES ('tidemark.start' = '{version}', 'tidemark.done' = '{version}')"
        )

    def upsert(self, fresh: DataFrame, ids: DataFrame) -> None:
        """Delete the rows of ``ids`` and insert ``fresh``; repeating it changes nothing more.

        A fresh row of another key replaces that key's rows; one without a key is an error. The table's rows are not
        shuffled: they are read by bucket, joined with the ids by bucket and written by bucket.
        """
        self._open()
        wanted = F.coalesce(F.col(self.key), F.raise_error(F.lit("a fresh row has no key")).cast(self.schema[self.key].dataType))
        fresh = materialize(fresh.select(*self._columns()).withColumn(self.key, wanted))
        given = ids.select(F.col(ids.columns[0]).alias(self.key)).where(F.col(self.key).isNotNull())
        keys = materialize(given.unionByName(fresh.select(self.key)).distinct())
        touched = [row[0] for row in keys.select(self._bucket(F.col(self.key))).distinct().collect()]
        if not touched:
            return
        version = self._begin()
        live = self._live()
        old = self._of(sorted(live[b] for b in touched if b in live))
        kept = old.join(keys, self.key, "left_anti").select(*self._columns())
        self._write(kept.unionByName(self._spread(fresh)), version)
        # A bucket that lost its last row has no file, but its partition says so.
        emptied = " ".join(self._partitions(sorted(f"{b}-{version}" for b in touched)))
        self.spark.sql(f"ALTER TABLE {self.table} ADD IF NOT EXISTS {emptied}")
        self._set("done", version)
