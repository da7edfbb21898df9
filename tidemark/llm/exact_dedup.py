"""Exact duplicates, with frequent texts taken out before the shuffle.

A Misra-Gries summary of each partition names all digests that may be frequent; counting those exactly settles which
are. There can be ``1 / share`` of them at most, so that they are broadcast, and their rows are resolved where they are.
All other digests are grouped by an ordinary shuffle, in which none has more than a small share of the rows.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import chunks, saved, table, texts_only

#: Counters of a summary, and so the most digests that are broadcast (40 bytes each).
COUNTERS = 1024


def text_digests(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``digest``: SHA-256 of the text's UTF-8 after lower-casing A-Z only; null counts as empty."""

    def run(batches):
        for batch in chunks(batches):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            digests = [hashlib.sha256(t.lower()).digest() for t in texts]  # of bytes: lower() changes A-Z only
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(digests, pa.binary())], ["doc_id", "digest"])

    return texts_only(docs).mapInArrow(run, "doc_id long, digest binary")


def misra_gries(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """``digest``, ``low``: at most ``counters`` rows for each partition; ``low`` is a count from below.

    Over all partitions, a digest's sum of ``low`` is less than its count by rows / ``counters`` at most.
    """

    def run(batches):
        held: Counter = Counter()
        for batch in batches:
            held.update(batch.column("digest").to_pylist())
            if len(held) > counters:
                cut = sorted(held.values(), reverse=True)[counters]
                held = Counter({d: n - cut for d, n in held.items() if n > cut})
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], ["digest", "low"])

    return digests.select("digest").mapInArrow(run, "digest binary, low long")


def exact_duplicates(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """``doc_id``, ``keep_id`` (the largest of equal texts), ``group_size``, ``kept``, ``digest``: a row for each row.

    Null ids come after all others when the one that stays is chosen; if all ids of a text are null, so is ``keep_id``,
    and its rows stay. Rows that repeat an id and a text are one document twice and share their fate.
    """
    digests = saved(text_digests(docs))
    rows = digests.count()
    summary = misra_gries(digests, counters).groupBy("digest").agg(F.sum("low").alias("low"))
    # Lows add up to the rows at most: fewer than `counters` digests can pass.
    suspects = F.broadcast(summary.filter(F.col("low") * counters > rows).select("digest"))
    figures = F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    frequent = F.broadcast(saved(digests.join(suspects, "digest").groupBy("digest").agg(*figures).filter(F.col("group_size") * counters > rows)))
    rest = digests.join(frequent, "digest", "left_anti")
    grouped = rest.groupBy("digest").agg(*figures)
    both = digests.join(frequent, "digest").unionByName(rest.join(grouped, "digest"))
    return both.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


SQL = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents
), g AS (
  SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
"""
