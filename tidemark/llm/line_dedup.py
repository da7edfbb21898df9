"""Lines that many documents share, found by probing a sharded minimal perfect hash.

The holders of each line hash are counted by an ordinary aggregate, and repeated lines kept. Shards of bounded size turn their hashes into
a minimal perfect hash and arrays at its places: a fingerprint, the count, and the document that keeps the line. Tasks
probe those arrays; lines aren't joined. Shards are sent out in rounds of a bounded number of bytes: usually one, and as many as
the index needs.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import chunks, saved, table, texts_only

BLANK = " \t\n\r\x0b\x0c"
#: Line hashes in a shard, on average.
SHARD_KEYS = 100_000
#: Bytes of shards that are broadcast at a time.
ROUND_BYTES = 48 << 20
#: Bits for each key in a level of the perfect hash.
SPARSE = 2
LEAST = np.iinfo(np.int64).min


def mixed(keys: np.ndarray, level: int) -> np.ndarray:
    """Another 64 bits for each level."""
    x = keys + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


class PerfectHash:
    """Distinct 64-bit keys to 0 .. n - 1. A key's bit is in the first level where no other key fell on it."""

    def __init__(self, levels: list[np.ndarray]) -> None:
        """``levels``: packed bits."""
        self.levels = [np.unpackbits(x).view(bool) for x in levels]
        before, self.ranks = 0, []
        for bits in self.levels:
            self.ranks.append((before + np.concatenate([[0], bits.cumsum()])).astype(np.uint32))
            before = int(self.ranks[-1][-1])

    @staticmethod
    def build(keys: np.ndarray) -> list[np.ndarray]:
        levels = []
        while len(keys):
            size = -(-SPARSE * len(keys) // 8) * 8
            at = (mixed(keys, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(np.packbits(alone))
            keys = keys[~alone[at]]
        return levels

    def places(self, keys: np.ndarray) -> np.ndarray:
        """Of keys that were not given, any place, or -1."""
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, (bits, ranks) in enumerate(zip(self.levels, self.ranks, strict=True)):
            at = (mixed(keys[open_], level) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at]
            out[open_[hit]] = ranks[at[hit]]
            open_ = open_[~hit]
        return out


def shard_file(keys: np.ndarray, prints: np.ndarray, counts: np.ndarray, keeps: np.ndarray) -> bytes:
    levels = PerfectHash.build(keys)
    at = PerfectHash(levels).places(keys)
    arrays = []
    for values, kind in ((prints, "<u8"), (np.minimum(counts, 0xFFFF), "<u2"), (keeps, "<i8")):
        array = np.empty(len(keys), kind)
        array[at] = values
        arrays.append(array)
    sizes = np.array([len(keys), len(levels), *map(len, levels)], "<u4")
    return b"".join(x.tobytes() for x in (sizes, *levels, *arrays))


class ShardIndex:
    def __init__(self, file: bytes) -> None:
        n, n_levels = np.frombuffer(file, "<u4", 2).tolist()
        sizes = np.frombuffer(file, "<u4", n_levels, 8).tolist()
        at, levels = 8 + 4 * n_levels, []
        for size in sizes:
            levels.append(np.frombuffer(file, np.uint8, size, at))
            at += size
        self.hash = PerfectHash(levels)
        self.prints = np.frombuffer(file, "<u8", n, at)
        self.counts = np.frombuffer(file, "<u2", n, at + 8 * n)
        self.keeps = np.frombuffer(file, "<i8", n, at + 10 * n)

    def probe(self, keys: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether a line is in, its count up to 65,535, and the document that keeps it."""
        at = self.hash.places(keys)
        known = (at >= 0) & (self.prints[at] == prints)
        return known, self.counts[at], self.keeps[at]


@lru_cache(2)
def _indexes(token: object) -> dict[int, ShardIndex]:
    return {shard: ShardIndex(file) for shard, file in token.value.items()}


def line_hashes(text: str, min_chars: int) -> tuple[list[str], list[int], list[int]]:
    """The lines, which of them are long enough, and 128-bit hashes of their keys."""
    lines, at, hashes = text.split("\n"), [], []
    for k, line in enumerate(lines):
        if len(line) >= min_chars and len(key := line.strip(BLANK)) >= min_chars:
            at.append(k)
            hashes.append(xxhash.xxh3_128_intdigest(key.encode().lower()))
    return lines, at, hashes


def halves(hashes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b"".join(h.to_bytes(16, "little") for h in hashes), "<u8").reshape(-1, 2)
    return data[:, 0].copy(), data[:, 1].copy()


def repeated_lines(docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """``key``, ``print``, ``n`` (rows of ``docs`` that hold the line), ``keep`` (their largest id) of lines in ``min_docs`` or more."""

    def run(batches):
        for batch in chunks(batches):
            keys, owners = [], []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                mine = set(line_hashes(text, min_chars)[2])
                keys += mine
                owners += [doc] * len(mine)
            if keys:
                low, high = halves(keys)
                yield pa.RecordBatch.from_arrays([pa.array(low.view(np.int64)), pa.array(high.view(np.int64)), pa.array(owners, pa.int64())], ["key", "print", "doc_id"])

    held = texts_only(docs).mapInArrow(run, "key long, print long, doc_id long")
    found = held.groupBy("key", "print").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max("doc_id"), F.lit(int(LEAST))).alias("keep"))
    return found.filter(F.col("n") >= min_docs)


def line_index(lines: DataFrame, shards: int) -> DataFrame:
    """``shard``, ``file``: a perfect hash and its arrays for each shard of the lines."""

    def build(key: tuple, rows: pa.Table) -> pa.Table:
        keys, prints, n, keep = (rows.column(c).to_numpy() for c in ("key", "print", "n", "keep"))
        # Two lines whose 64-bit keys clash can't both be in one hash; the second goes to an index of its own.
        files, left = [], np.arange(len(keys))
        while len(left):
            _, first = np.unique(keys[left], return_index=True)
            some = left[first]
            files.append(shard_file(keys[some].view(np.uint64), prints[some].view(np.uint64), n[some], keep[some]))
            left = np.delete(left, first)
        shard = key[0].as_py()
        return pa.table({"shard": pa.array([shard + shards * k for k in range(len(files))], pa.int32()), "file": pa.array(files, pa.binary())})

    dealt = lines.withColumn("shard", F.pmod("key", F.lit(shards)).cast("int"))
    return dealt.groupBy("shard").applyInArrow(build, "shard int, file binary")


def dedup_lines(docs: DataFrame, *carry: str, min_chars: int = 40, min_docs: int = 5, round_bytes: int = ROUND_BYTES, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """``doc_id``, the ``carry`` columns, ``text`` (without dropped lines), ``n_lines`` (before), ``n_dropped``.

    A line's key is the line without blanks at its ends, in lower case (A-Z). Keys of ``min_chars`` code points or more that
    ``min_docs`` rows or more hold stay only in the largest ``doc_id`` of those, there as often as it has them. A
    null text is one empty line. A null id is less than any other; if all holders have none, all keep the line. Rows that
    repeat an id each count, and each keeps what the id keeps.
    """
    spark = docs.sparkSession
    lines = saved(repeated_lines(docs, min_chars, min_docs))
    shards = max(1, -(-lines.count() // shard_keys))
    index = saved(line_index(lines, shards))
    sizes = sorted((r.shard, r.size) for r in index.select("shard", F.length("file").alias("size")).collect())  # two numbers a shard
    rounds, room = [[]], round_bytes
    for shard, size in sizes:
        if rounds[-1] and size > room:
            rounds.append([])
            room = round_bytes
        rounds[-1].append(shard)
        room -= size

    def prober(files: object, last: bool):
        def run(batches):
            indexes = _indexes(files)
            for batch in chunks(batches):
                split = [line_hashes(t, min_chars) for t in batch.column("text").to_pylist()]
                low, high = halves([h for _, _, hashes in split for h in hashes])
                ids = batch.column("doc_id").fill_null(int(LEAST)).to_numpy()
                owner = np.repeat(np.arange(len(split)), [len(s[1]) for s in split])
                at = np.array([k for s in split for k in s[1]], np.int64)
                drops, home = np.zeros(len(low), bool), (low.view(np.int64) % shards).astype(np.int64)
                for shard, one in indexes.items():
                    mine = np.flatnonzero(home == shard % shards)
                    known, counts, keeps = one.probe(low[mine], high[mine])
                    drops[mine] |= known & (counts >= min(min_docs, 0xFFFF)) & (keeps != ids[owner[mine]])
                gone = [set(x) for x in batch.column("_gone_at").to_pylist()]
                for o, k in zip(owner[drops].tolist(), at[drops].tolist(), strict=True):
                    gone[o].add(k)
                kept = batch.select(["doc_id", *carry])
                if last:
                    texts = ["\n".join(x for k, x in enumerate(s[0]) if k not in g) if g else "\n".join(s[0]) for s, g in zip(split, gone, strict=True)]
                    more = {"text": pa.array(texts, pa.string()), "n_lines": pa.array([len(s[0]) for s in split], pa.int64()), "n_dropped": pa.array([len(g) for g in gone], pa.int64())}
                else:
                    more = {"text": batch.column("text"), "_gone_at": pa.array([sorted(g) for g in gone], pa.list_(pa.int32()))}
                yield pa.RecordBatch.from_arrays([*kept.columns, *more.values()], [*kept.schema.names, *more])

        return run

    now = texts_only(docs, *carry).withColumn("_gone_at", F.array().cast("array<int>"))
    now = now.select("doc_id", *carry, "text", "_gone_at")
    base = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in now.schema.fields[:-1])
    for k, some in enumerate(rounds):
        rows = index.filter(F.col("shard").isin(some)).collect() if some else []
        files = spark.sparkContext.broadcast({r.shard: bytes(r.file) for r in rows})
        last = k == len(rounds) - 1
        now = now.mapInArrow(prober(files, last), base + (", n_lines long, n_dropped long" if last else ", _gone_at array<int>"))
        if not last:
            now = saved(now)
    return now


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = dedup_lines(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


SQL = """
WITH cut AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), lines AS (
  SELECT doc_id, i, parts[i] AS line,
    translate(trim(parts[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM cut)
), common AS (
  SELECT key, max(doc_id) AS keep FROM lines WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT l.doc_id, l.i, l.line, c.key IS NOT NULL AND l.doc_id <> c.keep AS gone FROM lines l LEFT JOIN common c ON l.key = c.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
