"""What the operators share: the tables, cut lineage, Arrow batches cut to a size, and keys for documents."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.session import materialize

#: Bytes of text that a Python task works on at a time; a longer text is a piece of its own.
CHUNK_BYTES = 3 << 19


def share_code(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, unless the session says where it is."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    share_code(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder, so that a lost executor costs one stage and nothing is computed twice."""
    return materialize(df)


def drop(df: DataFrame) -> None:
    """Remove the files of a table that ``saved`` wrote and no later step reads."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def texts_only(docs: DataFrame, *columns: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``text`` and the named columns: other columns can't clash with what an operator adds."""
    share_code(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *columns)


#: Ids that are broadcast at most, at 8 bytes each.
BROADCAST_IDS = 1_000_000


def by_ids(docs: DataFrame, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """``docs`` whose ``doc_id`` is in the table ``ids`` (or, ``left_anti``, is not); texts are shuffled only if the ids are too many to send out."""
    return docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "doc_id", how)


def release() -> None:
    """Give back what a finished task has freed: its worker lives on, and other stages need the memory."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that ``column`` holds about ``limit`` bytes in each, or adds up to it if it is a number."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = batch.column(column)
        if not pa.types.is_integer(sizes.type):
            sizes = pc.binary_length(sizes)
        sizes = pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False).cumsum()
        start = 0
        while start < batch.num_rows:
            before = sizes[start - 1] if start else 0
            end = max(start + 1, int(sizes.searchsorted(before + limit)))
            yield batch.slice(start, end - start)
            start = end
    release()
