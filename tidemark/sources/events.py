"""Event ids from JSON files, for runs without the database."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.schemas import EVENT, EVENT_FILE


def _rows(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    try:
        return spark.read.schema(EVENT_FILE).json(
            path, multiLine=multi_line, mode="PERMISSIVE", columnNameOfCorruptRecord="bad_text"
        )
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], EVENT_FILE)


def usable() -> Column:
    """Whether a row of an event file is an event."""
    return F.col("bad_text").isNull() & F.col("id").isNotNull() & F.col("serial").isNotNull()


def read_event_file(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Events of a JSON array, or of JSON lines; a missing file means no events."""
    return _rows(spark, path, multi_line).where(usable()).select(*EVENT.names)


def rejected_events(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """What ``read_event_file`` leaves out: rows without an id or a serial, and text that is no such JSON."""
    return _rows(spark, path, multi_line).where(~usable())
