"""A quality score learned from preferences: Bradley-Terry over pairs of documents.

A pair is a document labelled good and one labelled bad; the model is the logistic loss of the difference of their features,
so that it learns a ranking and no level. The level comes from the ranking: the cut is the quantile of the fitted
documents' utilities at the share of bad ones, and a document's score says where it stands against the cut.
"""

from __future__ import annotations

import operator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import chunks, table, texts_only

#: Labelled rows that the model is fitted on at most, taken by a hash of their id; pairs of them.
FIT_ROWS, PAIRS = 20_000, 200_000
#: The score at the cut.
AT_CUT = 0.3

NAMES = ("hard symbols", "soft symbols", "capitals", "digits", "marks of words", "repeats", "new words", "new pairs", "word length", "blanks")


def _bytes(characters: str) -> np.ndarray:
    out = np.zeros(256)
    out[list(characters.encode())] = 1
    return out


KINDS = np.stack([_bytes("$%&*#|<>{}[]\\^~=+_@/`"), _bytes(".,;:!?'\"()-"), _bytes("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _bytes("0123456789"), _bytes(" \t\n\r\x0b\x0c")])


def features(text: str) -> list[float]:
    """Of the whole text; shares between 0 and 1, of a text without words 0 but for the novelty of its words."""
    data, words = text.encode(), text.split()
    hard, soft, capitals, digits, blanks = KINDS @ np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    n, size = len(words), max(1, len(data))
    if not n:
        return [0.0] * 6 + [1.0, 1.0, 0.0, 0.0]
    repeats = sum(map(operator.eq, words, words[1:])) / n
    pairs = len(set(zip(words, words[1:]))) / max(1, n - 1) if n > 1 else 1.0
    marks = min(1.0, (hard + soft) / n / 4)
    return [hard / size, soft / size, capitals / size, digits / size, marks, repeats, len(set(words)) / n, pairs, min(1.0, (size - blanks) / n / 32), blanks / size]


@dataclass(frozen=True)
class Model:
    """Utility: weights times standard features. Score: 0 to 1, AT_CUT at ``cut``."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float

    def utility(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / self.scale @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        at = np.clip(self.utility(x) - self.cut, -500, 500)
        return 1 / (1 + np.exp(-at) * (1 - AT_CUT) / AT_CUT)


def fit(x: np.ndarray, good: np.ndarray, pairs: int = PAIRS, ridge: float = 1e-3, steps: int = 30) -> Model:
    """Newton's method on the pairs. Without both labels there is no pair: all utilities are 0, none below the cut."""
    good = good.astype(bool)
    mean, scale = (x.mean(0), x.std(0) + 1e-6) if len(x) else (np.zeros(len(NAMES)), np.ones(len(NAMES)))
    weights = np.zeros(x.shape[1])
    if good.all() or not good.any():
        return Model(mean, scale, weights, 0.0)
    z, random = (x - mean) / scale, np.random.default_rng(13)
    gap = z[random.choice(np.flatnonzero(good), pairs)] - z[random.choice(np.flatnonzero(~good), pairs)]
    for _ in range(steps):
        p = 1 / (1 + np.exp(np.clip(gap @ weights, -500, 500)))
        slope = gap.T @ p / pairs - ridge * weights
        step = np.linalg.solve((gap * (p * (1 - p))[:, None]).T @ gap / pairs + ridge * np.eye(len(weights)), slope)
        weights = weights + step
        if np.abs(step).max() < 1e-8:
            break
    ranked = np.sort(z @ weights)
    at = int((~good).sum())
    return Model(mean, scale, weights, float((ranked[at - 1] + ranked[at]) / 2))


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """Fit on ``fit_rows`` rows of ``labels`` (``doc_id``, ``quality``) at most, those with the least hashes; null labels are no labels."""
    chosen = labels.filter("quality IN (0, 1) AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    chosen = F.broadcast(chosen.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(fit_rows))  # 12 bytes a row

    def run(batches):
        for batch in chunks(batches):
            x = [features(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "quality", "x"])

    rows = texts_only(docs).join(chosen, "doc_id").mapInArrow(run, "doc_id long, quality int, x array<double>").collect()  # fit_rows at most, if ids are single
    rows.sort(key=lambda r: (r.doc_id, r.quality, r.x))
    return fit(np.array([r.x for r in rows]).reshape(-1, len(NAMES)), np.array([r.quality for r in rows]))


def score(docs: DataFrame, model: Model, *carry: str) -> DataFrame:
    """``doc_id``, ``text``, the ``carry`` columns and ``score``. A null text counts as empty and is scored so; each row is."""

    def run(batches):
        for batch in chunks(batches):
            scores = model.score(np.array([features(t) for t in batch.column("text").to_pylist()]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], [*batch.schema.names, "score"])

    whole = texts_only(docs, *carry)
    return whole.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in whole.schema) + ", score double")


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train(docs, labels.filter(~held_out()))
    scored = score(docs, model).select("doc_id", held_out().alias("held_out"), "score")
    return scored.withColumn("predicted", (F.col("score") >= AT_CUT).cast("int"))
