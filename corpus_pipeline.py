"""Raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; its result is written and read again as the next
one's ``docs``. All but the last return the columns that came in. A null text counts as empty, and goes on as empty.
``n_chars`` follows the text where a stage changes it. An empty table goes through as one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import line_dedup, near_dedup, packing, quality, secret_scan
from tidemark.llm.common import by_ids, saved, table


def _rest(docs: DataFrame) -> list[str]:
    return [c for c in docs.columns if c not in ("doc_id", "text")]


def _as_before(new: DataFrame, docs: DataFrame, changed: str | None = None) -> DataFrame:
    if changed and "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new = new.withColumn("n_chars", F.when(F.expr(changed), F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return new.select(docs.columns)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject; fitted on the labels of what comes in."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs.select("doc_id", "text", *[F.col(c).alias(f"in_{c}") for c in _rest(docs)]), model, *[f"in_{c}" for c in _rest(docs)])
    good = scored.filter(F.col("score") >= quality.AT_CUT)
    return good.select("doc_id", "text", *[F.col(f"in_{c}").alias(c) for c in _rest(docs)]).select(docs.columns)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that five or more documents share, which stay in one of them."""
    carried = docs.select("doc_id", "text", *[F.col(c).alias(f"in_{c}") for c in _rest(docs)])
    done = line_dedup.dedup_lines(carried, *[f"in_{c}" for c in _rest(docs)])
    done = done.select("doc_id", "text", F.col("n_dropped").alias("_gone"), *[F.col(f"in_{c}").alias(c) for c in _rest(docs)])
    return _as_before(done, docs, "_gone > 0")


def keep_one_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the least id. Documents without an id or without words stay."""
    dropped = saved(near_dedup.near_duplicates(docs, words=5, percent=80).filter("NOT kept").select("doc_id").distinct())
    return by_ids(docs, dropped, "left_anti").select(docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with the kind of each secret in its place; all documents stay."""
    found = secret_scan.scan(docs.select("doc_id", "text", *[F.col(c).alias(f"in_{c}") for c in _rest(docs)]), *[f"in_{c}" for c in _rest(docs)])
    masked = found.select(
        "doc_id", secret_scan.masked(F.col("text"), F.col("spans")).alias("text"), (F.size("spans") > 0).alias("_masked"), *[F.col(f"in_{c}").alias(c) for c in _rest(docs)]
    )
    return _as_before(masked, docs, "_masked")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens: the places of all documents' pieces."""
    import public_tokenizers

    return packing.pack(packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), 0, 2048), 2048)


STAGES = [
    ("quality_classifier", keep_good),
    ("line_dedup", drop_shared_lines),
    ("near_dedup", keep_one_of_near),
    ("secret_scans", mask_secrets),
    ("best_fit_packing", pack),
]

#: A fitted classifier and a tokenizer are beyond SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = saved(docs)
    return docs
