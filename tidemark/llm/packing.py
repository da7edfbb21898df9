"""Best-fit packing of token sequences, with proofs of how few bins each part needs.

Pieces are dealt by hash into parts of a bounded size. Each part packs by best-fit decreasing and compares its bins with
the largest lower bound that dual-feasible functions give. A part that meets its bound is certified: only its emptiest
bin, where rounding up leaves room, goes on. A part with a gap passes on the documents of its emptiest bins. What is passed on meets in
an eighth as many parts and is packed again, until one part is left or the bins of all parts meet the bound of all
pieces. A part's new bins replace the old ones only if they are fewer. No piece is dropped, and none is in two bins.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import bpe
from tidemark.llm.common import chunks, saved, table, texts_only

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECE + ", sequence_id long, offset long"


def token_pieces(docs: DataFrame, path: str, end_id: int, capacity: int) -> DataFrame:
    """Rows ``PIECE``: each document's ids and the end id, cut into pieces of ``capacity``; only longer ones are cut.

    A null text counts as empty and is one piece, the end id. Each row is a document, repeated ones too.
    """

    def run(batches):
        coder = bpe.word_bpe(path)
        for batch in chunks(batches):
            ids, counts = coder.encode(batch.column("text").to_pylist())
            ends = np.concatenate([[0], counts.cumsum()])
            rows = []
            for k, doc in enumerate(batch.column("doc_id").to_pylist()):
                mine = np.append(ids[ends[k] : ends[k + 1]], end_id).astype("<u4")
                for piece, at in enumerate(range(0, len(mine), capacity)):
                    part = mine[at : at + capacity]
                    rows.append((doc, piece, at, len(part), zlib.crc32(part.tobytes())))
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "piece", "start", "length", "ids_crc32"])

    return texts_only(docs).mapInArrow(run, PIECE)


def lower_bound(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> int:
    """Bins that pieces of these lengths need at least: the largest sum over three families of dual-feasible functions.

    Each function f maps lengths so that lengths fitting one bin have values adding up to 1 at most; hence the sum of
    all values bounds the bins. The families: the length itself; rounding of multiples, by k; large pieces to 1, small
    ones under a threshold to 0, by threshold. Sums are kept as whole numbers, so that no rounding error counts as a bin.
    """
    lengths, counts = lengths.astype(np.int64), counts.astype(np.int64)
    best = -(-int((lengths * counts).sum()) // capacity)
    for k in range(1, 12):
        scaled = (k + 1) * lengths
        value = np.where(scaled % capacity == 0, lengths * k, scaled // capacity * capacity)  # in units of 1 / (k * capacity)
        best = max(best, -(-int((value * counts).sum()) // (k * capacity)))
    for threshold in np.unique(lengths[lengths <= capacity // 2]):
        value = np.where(lengths > capacity - threshold, capacity, np.where(lengths >= threshold, lengths, 0))
        best = max(best, -(-int((value * counts).sum()) // capacity))
    return best


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Each piece's bin and offset by best-fit decreasing. Rooms of open bins are bits of one number."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_, n = 0, 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        above = open_ >> length
        if above:
            room = length + (above & -above).bit_length() - 1
            mine = waiting[room].pop()
            if not waiting[room]:
                open_ ^= 1 << room
        else:
            room, mine, n = capacity, n, n + 1
        bins[i], offsets[i] = mine, capacity - room
        left = room - length
        if left:
            waiting[left].append(mine)
            open_ |= 1 << left
    return bins, offsets


def packer(capacity: int, round_: int, passed_on: int, last: bool):
    """Packs the pieces of a part; a part that gets fewer bins than its pieces had before moves them."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        sizes = rows.column("length").to_numpy()
        bins, offsets = best_fit(sizes, capacity)
        before = rows.column("sequence_id")
        if not round_ or int(bins.max()) + 1 < pc.count_distinct(before).as_py():
            sequence = round_ << 56 | key[0].as_py() << 24 | bins
        else:
            sequence, offsets = before.to_numpy(), rows.column("offset").to_numpy()
        names, which = np.unique(sequence, return_inverse=True)
        fill = np.bincount(which, sizes).astype(np.int64)
        certified = len(names) == lower_bound(*np.unique(sizes, return_counts=True), capacity)
        emptiest = np.argsort(fill, kind="stable")[: 1 if certified else passed_on]
        goes_on = np.zeros(len(names), bool)
        goes_on[emptiest[fill[emptiest] < capacity]] = not last
        for name, values in (("sequence_id", sequence), ("offset", offsets)):
            rows = rows.set_column(rows.column_names.index(name), name, pa.array(values, pa.int64()))
        return rows.append_column("goes_on", pa.array(goes_on[which]))

    return run


def pack(pieces: DataFrame, capacity: int, part_size: int = 10_000, passed_on: int = 8, fan_in: int = 8) -> DataFrame:
    """``pieces`` (rows ``PIECE``, lengths from 1 to ``capacity``) with ``sequence_id`` and ``offset``.

    ``part_size``: pieces to a part on average; ``passed_on``: the emptiest bins that a part with a gap passes on;
    ``fan_in``: parts that meet in one of the next round. An empty input gives no rows.
    """
    pieces = saved(pieces)
    lengths = pieces.groupBy("length").count().toPandas()  # as many rows as lengths: `capacity` at most
    if lengths.empty:
        return pieces.select("*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    bound = lower_bound(lengths["length"].to_numpy(), lengths["count"].to_numpy(), capacity)
    parts = max(1, -(-int(lengths["count"].sum()) // part_size))
    deal = F.xxhash64("doc_id", "piece", "ids_crc32", "length")
    given = pieces.select("*", F.pmod(deal, F.lit(parts)).cast("int").alias("part"), F.lit(None).cast("long").alias("sequence_id"), F.lit(None).cast("long").alias("offset"))
    settled = []
    for round_ in range(99):

        done = saved(given.groupBy("part").applyInArrow(packer(capacity, round_, passed_on, parts == 1), f"{PIECE}, part int, sequence_id long, offset long, goes_on boolean"))
        settled.append(done.filter("not goes_on"))
        # Bins so far: those settled, and those that could still become fewer.
        used = sum(s.select("sequence_id").distinct().count() for s in settled)
        going = done.filter("goes_on")
        used += going.select("sequence_id").distinct().count()
        if parts == 1 or used <= bound:
            settled.append(going)
            break
        parts = -(-parts // fan_in)
        given = going.select(*[c for c in going.columns if c not in ("part", "goes_on")], F.pmod("part", F.lit(parts)).cast("int").alias("part"))
    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = token_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 0, 2048)
    return pack(pieces, 2048)
