"""Byte-level BPE over documents: encode to ids, decode ids to bytes.

Boundaries, merges and the cache are in ``bpe``; here they run over Arrow batches cut to a few megabytes of text. A null
text counts as empty, and gives no ids; each row gives a row, repeated ones too; a null ``doc_id`` stays null.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import bpe
from tidemark.llm.common import chunks, table, texts_only


#: Ids that a task decodes at a time.
CHUNK_IDS = 1 << 19


def lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], counts.cumsum()]), pa.int32()), pa.array(values, pa.int32()))


def encode(docs: DataFrame, path: str, *, offsets: bool = True) -> DataFrame:
    """``doc_id``, ``ids`` and, with ``offsets``, ``byte_at``: the byte of the text's UTF-8 at which each id's bytes begin.

    ``docs``: at least ``doc_id`` and ``text``; other columns are not read. ``path``: a rank file, on every machine.
    """

    def run(batches):
        coder = bpe.byte_bpe(path)
        for batch in chunks(batches):
            ids, counts = coder.encode(batch.column("text").to_pylist())
            columns = [batch.column("doc_id"), lists(ids, counts)]
            if offsets:
                lengths = coder.decoder.lengths[ids]
                at = lengths.cumsum() - lengths
                first = (counts.cumsum() - counts)[counts > 0]
                columns.append(lists(at - np.repeat(at[first], counts[counts > 0]), counts))
            yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "ids", "byte_at"][: 2 + offsets]
    schema = "doc_id long, ids array<int>" + ", byte_at array<int>" * offsets
    return texts_only(docs).mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``ids`` and ``decoded``, the bytes that the ids stand for; null ids give no bytes."""

    def run(batches):
        coder = bpe.byte_decoder(path)
        for batch in chunks(batches, "size", CHUNK_IDS):
            given = batch.column("ids")
            ids = given.flatten().to_numpy(zero_copy_only=False)
            data, lengths = coder.decode(ids)
            counts = np.asarray(batch.column("size"))
            ends = np.concatenate([[0], lengths.cumsum()])[np.concatenate([[0], counts.cumsum()])]
            decoded = pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), given, decoded.cast(pa.binary())], ["doc_id", "ids", "decoded"])

    whole = encoded.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    return whole.withColumn("size", F.size("ids").cast("long")).mapInArrow(run, "doc_id long, ids array<int>, decoded binary")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    decoded = decode(encode(table(spark, sf_dir, "documents"), path, offsets=False), path)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
