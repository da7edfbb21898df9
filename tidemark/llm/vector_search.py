"""Approximate nearest neighbours by cosine: probed lists, scanned by blocks of dimensions that abandon early.

Unit vectors are dealt into lists by the nearest of some centroids, which are fitted on a bounded sample. A query probes as many lists as
calibration asks for: the lists that hold the true neighbours of a sample of queries, found by brute force over all
rows. Within a list, vectors are rotated at random; then the distance over some of the columns estimates the whole, and a
hypothesis test against the query's fifth distance so far abandons most candidates after a block or two. Those that
remain are scored in double precision on the original vectors. Queries go through the index in blocks of a bounded size.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from tidemark.llm.common import saved, share_code, table

#: Rows that centroids are fitted on, and queries that calibrate the number of probed lists.
FIT_ROWS, CALIBRATION = 16_384, 256
#: Rows to a list on average, and lists at most; larger tables have longer lists, cut into chunks of CHUNK_ROWS.
LIST_ROWS, MOST_LISTS, CHUNK_ROWS = 1_024, 1_024, 16_384
#: Share of the calibrating queries' true neighbours that the probed lists must hold.
TARGET = 0.97
#: Queries that are broadcast at a time, and rows that a task scans at a time.
QUERY_BLOCK, ROW_BLOCK = 8_192, 2_048
#: Columns in a block, and how sure the test is before it abandons a candidate.
COLUMNS, CONFIDENCE = 16, 2.4


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id``, ``embedding`` as doubles: one row an id, without vectors that are null, zero or not finite throughout."""
    share_code(vectors.sparkSession)
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    fine = F.forall("embedding", lambda x: F.coalesce((F.abs(x) < math.inf) & ~F.isnan(x), F.lit(False)))
    v = v.filter(F.col("vec_id").isNotNull() & fine & F.exists("embedding", lambda x: x != 0))
    return v.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def unit(x: np.ndarray) -> np.ndarray:
    scaled = x / np.abs(x).max(1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def fit_centroids(sample: np.ndarray, lists: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means; an empty list keeps its centroid."""
    centroids = sample[np.random.default_rng(5).permutation(len(sample))[:lists]]
    for _ in range(rounds):
        nearest = (sample @ centroids.T).argmax(1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, sample)
        lengths = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(lengths > 1e-12, sums / np.maximum(lengths, 1e-12), centroids)
    return centroids


def cosines(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Row by row, in double precision."""
    dot = np.einsum("ij,ij->i", q, x)
    return dot / (np.sqrt(np.einsum("ij,ij->i", q, q)) * np.sqrt(np.einsum("ij,ij->i", x, x)))


class Best:
    """The ``k`` best (score, id) of each query so far."""

    def __init__(self, queries: int, k: int) -> None:
        self.k, self.scores, self.ids = k, np.full((queries, k), -np.inf), np.full((queries, k), np.iinfo(np.int64).max)

    def add(self, q: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        good = scores >= self.scores[q, -1]
        q, ids, scores = q[good], ids[good], scores[good]
        if not len(q):
            return
        touched = np.unique(q)
        q = np.concatenate([np.repeat(touched, self.k), q])
        ids, scores = np.concatenate([self.ids[touched].ravel(), ids]), np.concatenate([self.scores[touched].ravel(), scores])
        order = np.lexsort((ids, -scores, q))
        q, ids, scores = q[order], ids[order], scores[order]
        first = np.searchsorted(q, touched)
        take = first[:, None] + np.arange(self.k)
        self.ids[touched], self.scores[touched] = ids[take], scores[take]


def scan_list(best: Best, of: np.ndarray, q: np.ndarray, q_turned: np.ndarray, ids: np.ndarray, q_ids: np.ndarray, x: np.ndarray, turned: np.ndarray) -> None:
    """Offer a list's rows to the queries ``of``; ``turned``: unit vectors after the rotation."""
    width = turned.shape[1]
    floor = best.scores[of, -1]
    new = ~np.isfinite(floor)
    if new.any():
        # Without a fifth distance there is nothing to test against.
        some = of[new]
        scores = q_turned[some] @ turned.T
        scores[q_ids[some][:, None] == ids] = -np.inf
        k = min(best.k, scores.shape[1])
        least = np.partition(scores, -k, 1)[:, -k]
        at, rows = np.nonzero((scores >= least[:, None] - 1e-9) & np.isfinite(scores))
        best.add(some[at], ids[rows], cosines(q[some[at]], x[rows]))
        of, floor = of[~new], floor[~new]
    if not len(of):
        return
    reach = 2 - 2 * floor + 1e-9  # squared distance of the fifth
    done, pairs, partial = 0, None, np.zeros((len(of), len(ids)))
    while done < width:
        block = slice(done, min(done + COLUMNS, width))
        a, b = q_turned[of, block], turned[:, block]
        done = block.stop
        limit = reach * (done / width) * ((1 + CONFIDENCE / math.sqrt(done)) ** 2 if done < width else 1)
        if pairs is None:
            partial += (a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * (a @ b.T)
            alive = partial <= limit[:, None]
            if alive.mean() < 0.1 or done == width:
                pairs = np.nonzero(alive)
                partial = partial[pairs]
        else:
            step = a[pairs[0]] - b[pairs[1]]
            partial = partial + np.einsum("ij,ij->i", step, step)
            alive = partial <= limit[pairs[0]]
            pairs, partial = (pairs[0][alive], pairs[1][alive]), partial[alive]
    at, rows = pairs
    others = q_ids[of[at]] != ids[rows]
    at, rows = of[at[others]], rows[others]
    best.add(at, ids[rows], cosines(q[at], x[rows]))


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, target: float = TARGET) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: of each query the ``k`` nearest found, or all if fewer.

    Both frames: ``vec_id``, ``embedding``; other columns are not read. Vectors that are null, zero, not finite throughout, or
    without an id take no part; nor do those of another length than most. Of rows that repeat an id the least vector
    counts. A query's own id is no candidate. Ties go to the smaller id. Empty tables give no rows.
    """
    spark = vectors.sparkSession
    rows = saved(usable(vectors))
    asked = saved(usable(queries))
    lengths = rows.groupBy(F.size("embedding").alias("w")).count().orderBy(F.desc("count"), "w").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if lengths is None:
        return spark.createDataFrame([], schema)
    width, n = lengths["w"], lengths["count"]
    rows, asked = (d.filter(F.size("embedding") == width) for d in (rows, asked))
    shuffled = F.xxhash64("vec_id", F.lit(11))
    arrays = lambda d: (np.array([r.vec_id for r in d], np.int64), np.array([r.embedding for r in d]).reshape(-1, width))
    sample = unit(arrays(rows.orderBy(shuffled).limit(FIT_ROWS).collect())[1])
    centroids = fit_centroids(sample, max(1, min(MOST_LISTS, n // LIST_ROWS, len(sample))))
    turn = np.linalg.qr(np.random.default_rng(9).normal(size=(width, width)))[0]

    def deal(batches):
        for batch in batches:
            nearest = (unit(matrix(batch.column("embedding"), width)) @ centroids.T).argmax(1) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nearest, pa.int32())], [*batch.schema.names, "list"])

    dealt = saved(rows.mapInArrow(deal, "vec_id long, embedding array<double>, list int"))
    chunk = F.pmod(shuffled, F.greatest(F.lit(1), F.ceil(F.col("size") / CHUNK_ROWS))).cast("int")
    sizes = F.broadcast(dealt.groupBy("list").agg(F.count(F.lit(1)).alias("size")))  # MOST_LISTS rows at most
    index = dealt.join(sizes, "list").withColumn("chunk", chunk).repartition("list", "chunk").sortWithinPartitions("list", "chunk")
    index = saved(index.select("list", "vec_id", "embedding"))

    def scanner(sent: object, probes: int):
        def run(batches):
            q_ids, q = sent.value
            order = np.argsort(-(unit(q) @ centroids.T), 1, kind="stable")[:, :probes]
            probing = np.zeros((len(centroids), len(q_ids)), bool)
            probing[order, np.arange(len(q_ids))[:, None]] = True
            q_turned, best = unit(q) @ turn, Best(len(q_ids), k)
            for batch in batches:
                lists = batch.column("list").to_numpy()
                ids, x = batch.column("vec_id").to_numpy(), matrix(batch.column("embedding"), width)
                cuts = np.unique(np.concatenate([np.flatnonzero(np.diff(lists, prepend=-1)), np.arange(0, len(lists), ROW_BLOCK)]))
                for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(lists)], strict=True):
                    turned = unit(x[a:b]) @ turn
                    of = np.flatnonzero(probing[lists[a]])
                    for start in range(0, len(of), ROW_BLOCK):
                        scan_list(best, of[start : start + ROW_BLOCK], q, q_turned, ids[a:b], q_ids, x[a:b], turned)
            at, place = np.nonzero(np.isfinite(best.scores))
            for start in range(0, len(at), 10_000):
                i, j = at[start : start + 10_000], place[start : start + 10_000]
                yield pa.RecordBatch.from_arrays([pa.array(q_ids[i]), pa.array(best.ids[i, j]), pa.array(best.scores[i, j])], ["query_id", "vec_id", "score"])

        return run

    def found(block: list, probes: int) -> DataFrame:
        sent = spark.sparkContext.broadcast(arrays(block))
        return index.mapInArrow(scanner(sent, probes), "query_id long, vec_id long, score double")

    def ranked(parts: DataFrame) -> DataFrame:
        place = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        return parts.withColumn("rank", place).filter(F.col("rank") <= k)

    def blocks(d: DataFrame, probes: int) -> DataFrame:
        """All queries of ``d``, in blocks of a bounded number by hash."""
        count = d.count()
        n_blocks = max(1, -(-count // (QUERY_BLOCK // 2))) if count > QUERY_BLOCK else 1
        parts = None
        for b in range(n_blocks):
            part = found(d.filter(F.pmod(shuffled, F.lit(n_blocks)) == b).collect(), probes)
            parts = part if parts is None else parts.unionByName(part)
        return ranked(parts)

    # Probes: so many that the lists of true neighbours of some queries are among them.
    some = asked.orderBy(shuffled).limit(CALIBRATION).collect()
    if not some:
        return spark.createDataFrame([], schema)
    true = ranked(found(some, len(centroids))).join(dealt.select("vec_id", "list"), "vec_id").select("query_id", "list").collect()
    some_ids, some_q = arrays(some)
    order = np.argsort(np.argsort(-(unit(some_q) @ centroids.T), 1, kind="stable"), 1)
    row = {q: i for i, q in enumerate(some_ids.tolist())}
    needed = np.sort([order[row[t.query_id], t.list] + 1 for t in true] or [1])
    probes = int(needed[min(len(needed) - 1, math.ceil(target * len(needed)))])
    result = saved(blocks(asked, probes))
    # Exact for the rest: queries whose lists hold fewer than k candidates go through all lists.
    full = result.groupBy("query_id").count().filter(F.col("count") >= min(k, n - 1)).select(F.col("query_id").alias("vec_id"))
    short = saved(asked.join(full, "vec_id", "left_anti"))
    if probes < len(centroids) and not short.isEmpty():
        result = result.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").unionByName(blocks(short, len(centroids)))
    return result.select("query_id", "rank", "vec_id", "score")


def op10_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.filter("vec_id % 50 = 0"))
