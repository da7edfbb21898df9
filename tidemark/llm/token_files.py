"""Token ids in files of wavelet matrices.

Documents are sorted by id over range partitions; each partition writes shards of about a million ids. A shard's file is
one value: sizes, document ids and counts, and the bit planes of a wavelet matrix with its rank directory, compressed.
From it single ids, ranks, counts and places of an id are read without unpacking the ids; the container is Parquet, so
that any store which Spark can write holds the shards.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F
from pyspark.taskcontext import TaskContext

from tidemark.llm import bpe
from tidemark.llm.common import chunks, saved, table, texts_only

#: Ids in a shard, to the next document.
SHARD_IDS = 1 << 20
#: Bits between two entries of the rank directory.
BLOCK = 512
CODEC = pa.Codec("zstd", 1)
HEAD = struct.Struct("<4sQQBB")  # mark, documents, ids, planes, whether document ids can be null


def _parted(ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the zeros and of the ones: moving values by places costs less than half of doing so by masks."""
    return np.flatnonzero(~ones), np.flatnonzero(ones)


class WaveletMatrix:
    """Ids as bit planes, the highest first; each plane's order is the one above, its zeros before its ones."""

    def __init__(self, planes: list[np.ndarray], size: int) -> None:
        """``planes``: packed bits, of ``size`` bits each."""
        self.planes, self.size = planes, size
        self.directory, self.zeros = [], []
        for plane in planes:
            ones = np.bitwise_count(plane).astype(np.int64)
            padded = np.zeros(-(-len(ones) // (BLOCK // 8)) * (BLOCK // 8), np.int64)
            padded[: len(ones)] = ones
            self.directory.append(np.concatenate([[0], padded.reshape(-1, BLOCK // 8).sum(1).cumsum()]))
            self.zeros.append(size - int(self.directory[-1][-1]))

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        ids = ids.astype(np.uint32)
        n_planes = max(1, int(ids.max(initial=0)).bit_length())
        if n_planes <= 16:
            ids = ids.astype(np.uint16)
        planes = []
        for bit in reversed(range(n_planes)):
            ones = (ids & ids.dtype.type(1 << bit)) != 0
            planes.append(np.packbits(ones))
            ids = np.concatenate([ids.take(places) for places in _parted(ones)])
        return cls(planes, len(ids))

    def _bit(self, plane: int, at: int) -> int:
        return int(self.planes[plane][at >> 3]) >> (7 - (at & 7)) & 1

    def _ones(self, plane: int, at: int) -> int:
        """Ones before ``at``."""
        block = at // BLOCK
        data = self.planes[plane][block * BLOCK // 8 : at >> 3]
        rest = int(self.planes[plane][at >> 3]) >> (8 - (at & 7)) if at & 7 else 0
        return int(self.directory[plane][block]) + int(np.bitwise_count(data).sum(dtype=np.int64)) + rest.bit_count()

    def _select(self, plane: int, bit: int, k: int) -> int:
        """Place of the ``k``-th (from 0) such bit: by the directory, then within the block."""
        ranks = self.directory[plane]
        if not bit:
            ranks = np.arange(len(ranks)) * BLOCK - ranks
        block = int(np.searchsorted(ranks, k, side="right")) - 1
        bits = np.unpackbits(self.planes[plane][block * BLOCK // 8 : (block + 1) * BLOCK // 8])
        return block * BLOCK + int(np.flatnonzero(bits == bit)[k - int(ranks[block])])

    def access(self, at: int) -> int:
        value = 0
        for plane in range(len(self.planes)):
            bit, ones = self._bit(plane, at), self._ones(plane, at)
            value, at = value << 1 | bit, self.zeros[plane] + ones if bit else at - ones
        return value

    def _range(self, value: int, end: int) -> tuple[int, int]:
        """Below the last plane, where ``value``'s occurrences before ``end`` stand."""
        low, high = 0, end
        if value >> len(self.planes):
            return 0, 0
        for plane in range(len(self.planes)):
            a, b = self._ones(plane, low), self._ones(plane, high)
            if value >> (len(self.planes) - 1 - plane) & 1:
                low, high = self.zeros[plane] + a, self.zeros[plane] + b
            else:
                low, high = low - a, high - b
        return low, high

    def rank(self, value: int, end: int) -> int:
        """Occurrences before ``end``."""
        low, high = self._range(value, end)
        return high - low

    def count(self, value: int) -> int:
        return self.rank(value, self.size)

    def select(self, value: int, k: int) -> int:
        """Place of the ``k``-th occurrence, from 0; IndexError if there are fewer."""
        low, high = self._range(value, self.size)
        if not 0 <= k < high - low:
            raise IndexError(k)
        at = low + k
        for plane in reversed(range(len(self.planes))):
            if value >> (len(self.planes) - 1 - plane) & 1:
                at = self._select(plane, 1, at - self.zeros[plane])
            else:
                at = self._select(plane, 0, at)
        return at

    def all(self) -> np.ndarray:
        """All ids in order: each plane undoes the parting of the one above it."""
        values = np.zeros(self.size, np.uint32 if len(self.planes) > 16 else np.uint16)
        for weight, plane in enumerate(reversed(self.planes)):
            low, high = _parted(np.unpackbits(plane, count=self.size).view(bool))
            above = np.empty_like(values)
            above[low] = values[: len(low)]
            above[high] = values[len(low) :] | values.dtype.type(1 << weight)
            values = above
        return values


class Shard:
    """What one file holds: documents' ids (or None), their numbers of token ids, and the wavelet matrix of those."""

    def __init__(self, docs: np.ndarray, known: np.ndarray, counts: np.ndarray, matrix: WaveletMatrix) -> None:
        self.docs, self.known, self.counts, self.matrix = docs, known, counts, matrix

    def to_bytes(self) -> bytes:
        m = self.matrix
        parts = [self.docs.astype("<i8"), self.known.astype("u1"), self.counts.astype("<u4"), *m.planes]
        data = b"".join(p.tobytes() for p in parts)
        return HEAD.pack(b"WMX1", len(self.docs), m.size, len(m.planes), 1) + struct.pack("<Q", len(data)) + CODEC.compress(data, asbytes=True)

    @classmethod
    def from_bytes(cls, data: bytes) -> Shard:
        mark, n_docs, size, n_planes, _ = HEAD.unpack_from(data)
        if mark != b"WMX1":
            raise ValueError("not a wavelet matrix file")
        (length,) = struct.unpack_from("<Q", data, HEAD.size)
        raw = np.frombuffer(CODEC.decompress(data[HEAD.size + 8 :], length, asbytes=True), np.uint8)
        cuts = np.cumsum([8 * n_docs, n_docs, 4 * n_docs, *[-(-size // 8)] * n_planes])
        docs, known, counts, *planes = np.split(raw, cuts)[:-1]
        return cls(docs.view("<i8"), known.view(bool), counts.view("<u4").astype(np.int64), WaveletMatrix(planes, size))


def write_shards(docs: DataFrame, path: str, end_id: int, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Encode ``docs`` by the vocabulary at ``path`` and write shards; returns the table of files.

    Rows: ``part``, ``seq`` (their order is that of document ids, nulls first), ``n_docs``, ``n_ids``, ``file``. A null
    text counts as empty: the end id alone. Repeated ids are documents of their own, in any order among each other.
    """

    def run(batches):
        coder, part, seq = bpe.word_bpe(path), TaskContext.get().partitionId(), 0
        docs_, known, counts_, ids_, held = [], [], [], [], 0

        def shard():
            ids = np.concatenate(ids_)
            file = Shard(np.concatenate(docs_), np.concatenate(known), np.concatenate(counts_), WaveletMatrix.build(ids)).to_bytes()
            n = sum(map(len, docs_))
            arrays = [pa.array([x], t) for x, t in ((part, pa.int32()), (seq, pa.int32()), (n, pa.int64()), (len(ids), pa.int64()), (file, pa.binary()))]
            return pa.RecordBatch.from_arrays(arrays, ["part", "seq", "n_docs", "n_ids", "file"])

        for batch in chunks(batches):
            ids, counts = coder.encode(batch.column("text").to_pylist())
            ends = counts.cumsum() + np.arange(1, len(counts) + 1)
            whole = np.full(len(ids) + len(counts), end_id, np.uint32)
            inner = np.ones(len(whole), bool)
            inner[ends - 1] = False
            whole[inner] = ids
            column = batch.column("doc_id")
            docs_.append(column.fill_null(0).to_numpy()), known.append(column.is_valid().to_numpy(zero_copy_only=False))
            counts_.append(counts + 1), ids_.append(whole)
            held += len(whole)
            if held >= shard_ids:
                yield shard()
                docs_, known, counts_, ids_, held, seq = [], [], [], [], 0, seq + 1
        if docs_:
            yield shard()

    sorted_ = texts_only(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    return saved(sorted_.mapInArrow(run, "part int, seq int, n_docs long, n_ids long, file binary"))


def read_shards(files: DataFrame) -> DataFrame:
    """Per document, from the files alone: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32``."""

    def run(batches):
        for batch in batches:
            for part, seq, data in zip(*(batch.column(c).to_pylist() for c in ("part", "seq", "file")), strict=True):
                shard = Shard.from_bytes(data)
                ids, ends = shard.matrix.all().astype("<u4"), shard.counts.cumsum()
                crcs = [zlib.crc32(ids[a:b]) for a, b in zip((ends - shard.counts).tolist(), ends.tolist(), strict=True)]
                n = len(crcs)
                arrays = [
                    pa.array(np.full(n, part, np.int32)), pa.array(np.full(n, seq, np.int32)), pa.array(shard.docs, mask=~shard.known),
                    pa.array(ends - shard.counts), pa.array(shard.counts), pa.array(crcs, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, ["part", "seq", "doc_id", "at", "n_tokens", "ids_crc32"])

    # Two steps of prefix sums: over parts, of which there are as many as tasks, and over the files of each.
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("in_part"))
    parts = parts.select("part", (F.sum("in_part").over(W.orderBy("part")) - F.col("in_part")).alias("before_part"))
    within = F.sum("n_ids").over(W.partitionBy("part").orderBy("seq")) - F.col("n_ids")
    before = files.select("part", "seq", within.alias("before_file")).join(parts, "part")
    docs = files.select("part", "seq", "file").mapInArrow(run, "part int, seq int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return docs.join(before, ["part", "seq"]).select(
        "doc_id", (F.col("at") + F.col("before_file") + F.col("before_part")).alias("start"), "n_tokens", "ids_crc32"
    )


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return read_shards(write_shards(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2))
