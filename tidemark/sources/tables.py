"""Read the input tables: parquet folders, or a remote database in partitioned ranges."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tidemark.schemas import TABLES


@dataclass(frozen=True)
class TableConfig:
    """Where the tables are. With ``url`` they are read over JDBC, else as parquet under ``root``.

    ``partition_by`` maps a table to ``(column, lower, upper)``; the bounds only shape the ranges, rows outside
    them are still read. ``partitions`` is also the number of connections in use at once.
    """

    root: str | None = None
    url: str | None = None
    user: str | None = None
    password: str | None = None
    timeout_seconds: int = 0
    partitions: int = 10
    names: dict[str, str] = field(default_factory=dict)
    partition_by: dict[str, tuple[str, str, str]] = field(default_factory=dict)

    @classmethod
    def from_env(cls, prefix: str = "TIDEMARK_DB_", **other) -> "TableConfig":
        env = lambda name, default="": os.environ.get(prefix + name, default)
        url = f"jdbc:sqlserver://{env('SERVER')}:{env('PORT', '1433')};databaseName={env('NAME')}"
        return cls(
            url=url, user=env("USER"), password=env("PASSWORD"), timeout_seconds=int(env("TIMEOUT", "0")), **other
        )


def jdbc_options(name: str, cfg: TableConfig) -> dict[str, str]:
    options = {
        "url": cfg.url,
        "dbtable": cfg.names.get(name, name),
        "user": cfg.user or "",
        "password": cfg.password or "",
        "queryTimeout": str(cfg.timeout_seconds),
        "fetchsize": "10000",
    }
    if name in cfg.partition_by:
        column, lower, upper = cfg.partition_by[name]
        options |= {
            "partitionColumn": column,
            "lowerBound": lower,
            "upperBound": upper,
            "numPartitions": str(cfg.partitions),
        }
    return options


def read_table(spark: SparkSession, name: str, cfg: TableConfig) -> DataFrame:
    """One table; parquet ones with their declared schema when there is one."""
    if cfg.url:
        return spark.read.format("jdbc").options(**jdbc_options(name, cfg)).load()
    reader = spark.read.schema(TABLES[name]) if name in TABLES else spark.read
    return reader.parquet(f"{cfg.root}/{cfg.names.get(name, name)}")


def read_tables(spark: SparkSession, cfg: TableConfig, *names: str) -> dict[str, DataFrame]:
    return {name: read_table(spark, name, cfg) for name in names}
