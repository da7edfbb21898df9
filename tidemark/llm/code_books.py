"""Vectors compressed to a code for each part, by code books whose entries move while bounds spare most distances.

A vector's components become integers, and it is cut into parts; each part position has a book of entries. In a round, each
part is assigned to its nearest entry, and entries move to the means of their parts. Drake's and Hamerly's bounds go with each part from
round to round: its ``b`` closest entries in order, an upper bound of the distance to the first, a lower bound for each other, and an outer
bound for all entries not listed. Entries' moves loosen the bounds; only where they no longer tell the nearest entry apart are distances worked
out, in integers, among as many listed entries as the bounds leave open, or all. ``b`` shrinks to the depth that a round needed.
Bounds are kept as 32-bit numbers, rounded outwards, and an equality is never taken for certain, so that all decisions are exact.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.llm.common import chunks, drop, saved, share_code, table

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Components beyond this, either way, count as this much, so that squared distances fit 64 bits.
LARGEST = 1 << 24
#: Labels whose sums are broadcast at most.
BROADCAST_LABELS = 1_000_000
#: Bounds are widened by this share: more than the roundings of a few operations on 64-bit numbers add up to.
SLACK = 1e-12


class Books(NamedTuple):
    """``entries``: integers by part, entry, position within the part."""

    entries: np.ndarray

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def decode(self, code: bytes) -> np.ndarray:
        """The integer vector that a code stands for."""
        return np.concatenate([self.entries[p, c] for p, c in enumerate(code)]) if len(code) else np.zeros(0, np.int64)


def _up(x: np.ndarray) -> np.ndarray:
    return np.nextafter((x * (1 + SLACK)).astype(np.float32), np.float32(np.inf))


def _down(x: np.ndarray) -> np.ndarray:
    return np.maximum(np.nextafter((x * (1 - SLACK)).astype(np.float32), np.float32(-np.inf)), np.float32(0))


def squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances; ``entries`` has one axis more than ``points``, before the last."""
    away = points[:, None, :] - entries
    return np.einsum("ijk,ijk->ij", away, away)


class Bounds:
    """What is known of some parts of one position: ``near`` (entries, the assigned one first), ``upper``, ``low`` (from the second listed entry on), ``outer``."""

    def __init__(self, near: np.ndarray, upper: np.ndarray, low: np.ndarray, outer: np.ndarray) -> None:
        self.near, self.upper, self.low, self.outer = near, upper, low, outer

    @classmethod
    def unknown(cls, n: int, b: int) -> Bounds:
        return cls(np.zeros((n, b), np.uint8), np.full(n, np.inf, np.float32), np.zeros((n, b - 1), np.float32), np.zeros(n, np.float32))

    def cut(self, b: int) -> Bounds:
        """With ``b`` entries: those left out count for the outer bound."""
        out = np.minimum(self.outer, self.low[:, b - 1 :].min(1, initial=np.inf))
        return Bounds(self.near[:, :b].copy(), self.upper, self.low[:, : b - 1].copy(), out)

    def move(self, moved: np.ndarray) -> None:
        """Loosen by how far each entry has moved."""
        self.upper = _up(self.upper.astype(np.float64) + moved[self.near[:, 0]])
        self.low = _down(np.maximum(self.low.astype(np.float64) - moved[self.near[:, 1:]], 0))
        self.outer = _down(np.maximum(self.outer.astype(np.float64) - moved.max(), 0))

    def settle(self, points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, int]:
        """Make the first listed entry the nearest, ties to the lower index.

        Returns the depth that each part needed (0: bounds alone; 1: the distance to the first; up to b; b + 1: all entries), and
        the number of distances worked out.
        """
        b, k = self.near.shape[1], len(entries)
        depth = np.zeros(len(points), np.int64)
        # Ordered bounds: of each place, and all behind it.
        ordered = np.minimum.accumulate(np.column_stack([self.low, self.outer])[:, ::-1], 1)[:, ::-1]
        open_ = np.flatnonzero(self.upper >= ordered[:, 0])
        exact = squared(points[open_], entries[self.near[open_, :1]])[:, 0]
        self.upper[open_] = np.minimum(self.upper[open_], _up(np.sqrt(exact)))
        depth[open_] = 1
        worked = len(open_)
        # The first place whose bound, and so all behind it, is farther than the assigned entry.
        clear = self.upper[:, None] < ordered
        first = np.where(clear.any(1), clear.argmax(1) + 1, b + 1)
        for z in range(2, b + 1):
            rows = open_[first[open_] == z]
            if not len(rows):
                continue
            some = np.sort(self.near[rows, :z], 1)
            away = squared(points[rows], entries[some])
            order = np.argsort(away, 1, kind="stable")
            away, depth[rows] = np.sqrt(np.take_along_axis(away, order, 1)), z
            self.near[rows, :z] = np.take_along_axis(some, order, 1)
            self.upper[rows], self.low[rows, : z - 1] = _up(away[:, 0]), _down(away[:, 1:])
            worked += z * len(rows)
        rows = open_[first[open_] == b + 1]
        if len(rows):
            away = squared(points[rows], entries[None])
            order = np.argsort(away, 1, kind="stable")
            away, depth[rows] = np.sqrt(np.take_along_axis(away, order, 1)), b + 1
            self.near[rows] = order[:, :b]
            self.upper[rows], self.low[rows] = _up(away[:, 0]), _down(away[:, 1:b])
            self.outer[rows] = _down(away[:, b]) if b < k else np.inf
            worked += k * len(rows)
        return depth, worked

    def pack(self) -> tuple[np.ndarray, np.ndarray]:
        return self.near, np.column_stack([self.upper, self.low, self.outer])

    @classmethod
    def unpack(cls, near: np.ndarray, bounds: np.ndarray) -> Bounds:
        return cls(near.copy(), bounds[:, 0].copy(), bounds[:, 1:-1].copy(), bounds[:, -1].copy())


def _fixed(column: pa.Array, kind: str, n: int) -> np.ndarray:
    """The values of a binary column whose values have one size, a row for each."""
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, kind).reshape(n, -1) if data else np.zeros((n, 0), kind)


def _binary(rows: np.ndarray) -> pa.Array:
    rows = np.ascontiguousarray(rows)
    n, width = len(rows), rows.itemsize * (rows.shape[1] if rows.ndim > 1 else 1)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((np.arange(n + 1) * width).astype(np.int32)), pa.py_buffer(rows.tobytes())])


def whole_numbers(vectors: DataFrame, vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``vec_id``, ``label``, ``ints`` (32-bit, as bytes) of rows whose vector is neither null nor holds nulls or non-finite components.

    Vectors of another length than the least ``vec_id``'s are left out too; zeros fill up a length that the parts don't divide.
    """
    share_code(vectors.sparkSession)
    label = F.col("label") if "label" in vectors.columns else F.lit(None).cast("int")
    named = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), F.col(vector_col).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kept = named.filter(F.col("vector").isNotNull() & finite)
    schema = T.StructType([*kept.schema.fields[:2], T.StructField("ints", T.BinaryType())])

    def run(batches):
        for batch in batches:
            vector = batch.column("vector")
            sizes = np.diff(vector.offsets.to_numpy())
            values = np.clip(np.floor(vector.flatten().to_numpy(zero_copy_only=False) * scale), -LARGEST, LARGEST).astype("<i4")
            ends = 4 * np.concatenate([[0], sizes.cumsum()]).astype(np.int32)
            ints = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(values.tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), ints], ["vec_id", "label", "ints"])

    return kept.mapInArrow(run, schema)


def _round(state: DataFrame, books: np.ndarray, moved: np.ndarray, before: list[int] | None, b: list[int]) -> DataFrame:
    """Assign all parts; the rows with their new bounds, and a row of figures from each task.

    ``figures``: numbers by slot. Of part p and entry e, the change of its count and of its sums; then the depths that parts needed.
    """
    parts, k, width = books.shape
    b_in = np.concatenate([[0], np.cumsum(before or b)])
    schema = T.StructType([*state.schema.fields[:3], *T.DataType.fromDDL("near binary, bounds binary, figures array<long>").fields])
    names = [f.name for f in schema]

    def run(batches):
        change, depths = np.zeros((parts, k, width + 1), np.int64), np.zeros((parts, k + 3), np.int64)
        nothing = None
        for batch in chunks(batches, "ints"):
            n = batch.num_rows
            ints = _fixed(batch.column("ints"), "<i4", n).astype(np.int64)
            points = np.zeros((n, parts * width), np.int64)
            points[:, : ints.shape[1]] = ints
            if before:
                near, bounds = _fixed(batch.column("near"), "u1", n), _fixed(batch.column("bounds"), "<f4", n)
            out = []
            for p in range(parts):
                mine = points[:, p * width : (p + 1) * width]
                if before:
                    known = Bounds.unpack(near[:, b_in[p] : b_in[p + 1]], bounds[:, b_in[p] + p : b_in[p + 1] + p + 1]).cut(b[p])
                    old = known.near[:, 0].copy()
                    known.move(moved[p])
                else:
                    known, old = Bounds.unknown(n, b[p]), None
                depth, worked = known.settle(mine, books[p])
                depths[p, : b[p] + 2] += np.bincount(depth, minlength=b[p] + 2)
                depths[p, -1] += worked
                new = known.near[:, 0]
                rows = np.arange(n) if old is None else np.flatnonzero(new != old)
                with_one = np.column_stack([np.ones(len(rows), np.int64), mine[rows]])
                np.add.at(change[p], new[rows], with_one)
                if old is not None:
                    np.subtract.at(change[p], old[rows], with_one)
                out.append(known.pack())
            arrays = [batch.column("vec_id"), batch.column("label"), batch.column("ints"), _binary(np.hstack([x for x, _ in out])), _binary(np.hstack([x for _, x in out]).astype("<f4"))]
            yield pa.RecordBatch.from_arrays([*arrays, pa.nulls(n, pa.list_(pa.int64()))], names)
            nothing = batch.column("label").type
        if nothing is not None:
            figures = np.concatenate([change.ravel(), depths.ravel()]).tolist()
            blank = [pa.nulls(1, t) for t in (pa.int64(), nothing, pa.binary(), pa.binary(), pa.binary())]
            yield pa.RecordBatch.from_arrays([*blank, pa.array([figures], pa.list_(pa.int64()))], names)

    return saved(state.mapInArrow(run, schema))


def _last(state: DataFrame, books: np.ndarray, moved: np.ndarray, b: list[int]) -> DataFrame:
    parts, _, width = books.shape
    b_in = np.concatenate([[0], np.cumsum(b)])
    schema = T.StructType([*state.schema.fields[:2], *T.DataType.fromDDL("code binary, error long").fields])

    def run(batches):
        for batch in chunks(batches, "ints"):
            n = batch.num_rows
            ints = _fixed(batch.column("ints"), "<i4", n).astype(np.int64)
            points = np.zeros((n, parts * width), np.int64)
            points[:, : ints.shape[1]] = ints
            near, bounds = _fixed(batch.column("near"), "u1", n), _fixed(batch.column("bounds"), "<f4", n)
            code, error = np.zeros((n, parts), np.uint8), np.zeros(n, np.int64)
            for p in range(parts):
                mine = points[:, p * width : (p + 1) * width]
                known = Bounds.unpack(near[:, b_in[p] : b_in[p + 1]], bounds[:, b_in[p] + p : b_in[p + 1] + p + 1])
                known.move(moved[p])
                known.settle(mine, books[p])
                code[:, p] = known.near[:, 0]
                error += ((mine - books[p][code[:, p]]) ** 2).sum(1)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), _binary(code), pa.array(error)], ["vec_id", "label", "code", "error"])

    return state.mapInArrow(run, schema)


def compress(vectors: DataFrame, vector_col: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, log: list | None = None) -> tuple[DataFrame, Books]:
    """``vec_id``, ``label``, ``code`` (an entry's index, 255 at most, for each part) and ``error`` of each vector, and the books.

    Books begin as the parts of the least ``entries`` ids' vectors (of equal ids in the order of their bytes; rows without an id come
    last); of fewer rows, all are entries. A table without a row that counts gives none, and books without entries. Repeated rows are
    rows. There is one round at least.
    ``log`` takes each round's ``b`` by part, and how many parts needed which depth and distances.
    """
    now = saved(whole_numbers(vectors, vector_col, scale))
    order = F.col("vec_id").asc_nulls_last(), F.col("ints")
    least = now.orderBy(*order).select("ints").first()
    if least is None:
        empty = now.select("vec_id", "label", F.col("ints").alias("code"), F.lit(0).cast("long").alias("error"))
        return empty, Books(np.zeros((parts, 0, 0), np.int64))
    size = len(least.ints) // 4
    now = now.filter(F.length("ints") == 4 * size)
    first = now.orderBy(*order).limit(entries).collect()
    width = max(1, -(-size // parts))
    start = np.zeros((len(first), parts * width), np.int64)
    for k, row in enumerate(first):
        start[k, :size] = np.frombuffer(row.ints, "<i4")
    books = start.reshape(len(first), parts, width).swapaxes(0, 1).copy()
    k = len(first)
    floor = max(1, min(k, max(2, k // 8)))
    b, before = [max(floor, k // 4)] * parts, None
    moved = np.zeros((parts, k))
    counts, sums = np.zeros((parts, k), object), np.zeros((parts, k, width), object)
    for _ in range(rounds):
        after = _round(now, books, moved, before, b)
        drop(now)
        figures = after.filter("figures IS NOT NULL").select(F.posexplode("figures").alias("slot", "value")).groupBy("slot").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
        flat = np.zeros(parts * k * (width + 1) + parts * (k + 3), object)
        for row in figures.collect():  # as many as slots, whatever the data
            flat[row.slot] = int(row.value)
        change, depths = flat[: parts * k * (width + 1)].reshape(parts, k, width + 1), flat[parts * k * (width + 1) :].reshape(parts, k + 3)
        counts, sums = counts + change[:, :, 0], sums + change[:, :, 1:]
        new = books.copy()
        for p, e in zip(*np.nonzero(counts), strict=True):
            new[p, e] = [int(s // counts[p, e]) for s in sums[p, e]]
        moved = np.sqrt(((new - books) ** 2).sum(2).astype(np.float64)) * (1 + SLACK)
        books, now, before = new, after.filter("figures IS NULL").drop("figures"), list(b)
        if log is not None:
            log.append((before, depths.tolist()))
        b = [max(floor, min(x, max([z for z in range(2, x + 1) if depths[p, z]], default=floor))) for p, x in enumerate(b)]
    return _last(now, books, moved, before), Books(books)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = compress(table(spark, sf_dir, "embeddings"))
    rows = saved(codes)
    sums = saved(rows.groupBy("label").agg(F.sum("error").alias("label_error")).select(F.col("label").alias("of"), "label_error"))
    few = F.broadcast(sums) if sums.count() <= BROADCAST_LABELS else sums
    done = rows.join(few, rows["label"].eqNullSafe(few["of"]))
    return done.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def sql() -> str:
    """The same rounds, each a few table expressions, for vectors of 64 components."""
    width = 64 // PARTS
    steps = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS place, vec_id, label,
         list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)""",
        f"""pieces AS MATERIALIZED (
  SELECT place, p, v[p * {width} + 1 : (p + 1) * {width}] AS part FROM kept, range({PARTS}) AS r(p)
)""",
        f"books0 AS MATERIALIZED (SELECT p, place - 1 AS e, part AS entry FROM pieces WHERE place <= {ENTRIES})",
    ]
    for r in range(ROUNDS + 1):
        steps.append(f"""assigned{r} AS MATERIALIZED (
  SELECT place, p, any_value(part) AS part, min((away, e))[1] AS away, min((away, e))[2] AS e
  FROM (SELECT place, pieces.p, part, e, list_sum(list_transform(range(1, {width} + 1), lambda i: (part[i] - entry[i]) * (part[i] - entry[i])))::BIGINT AS away
        FROM pieces JOIN books{r} AS b ON pieces.p = b.p)
  GROUP BY place, p
)""")
        if r < ROUNDS:
            steps.append(f"""books{r + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(n.entry, b.entry) AS entry
  FROM books{r} AS b LEFT JOIN (
    SELECT p, e, [{", ".join(f"floor(sum(part[{i}]) / count(*))::BIGINT" for i in range(1, width + 1))}] AS entry FROM assigned{r} GROUP BY p, e
  ) AS n ON n.p = b.p AND n.e = b.e
)""")
    steps.append(f"""coded AS (
  SELECT place, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(away)::BIGINT AS error FROM assigned{ROUNDS} GROUP BY place
)""")
    steps.append(f"digest AS (SELECT sha256(string_agg(array_to_string(entry, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM books{ROUNDS})")
    return "WITH " + ",\n".join(steps) + """
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (place), digest"""
