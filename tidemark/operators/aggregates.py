"""Counts and document lists per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

# A document list is cut to this many characters, and is joined with this separator.
LIST_CHARS = 1000
LIST_SEPARATOR = ", "


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys held by more than one row; NULL is a key like any other."""
    return df.groupBy(key).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def doc_counts(lines: DataFrame, item: str = "item", doc: str = "doc_num") -> DataFrame:
    """Lines per (item, document): the small relation that counts and lists are made from."""
    return lines.groupBy(item, doc).agg(F.count("*").alias("n_lines"))


def docs_per_item(counts: DataFrame, item: str = "item", distinct: bool = False) -> DataFrame:
    """Lines (or distinct documents) per item, NULL document numbers not counted."""
    known = F.col("doc_num").isNotNull()
    n = F.count(F.when(known, 1)) if distinct else F.sum(F.when(known, F.col("n_lines")).otherwise(0))
    return counts.groupBy(item).agg(n.cast("bigint").alias("n_docs"))


def doc_list(
    counts: DataFrame, item: str = "item", distinct: bool = False, chars: int | None = LIST_CHARS
) -> DataFrame:
    """Documents of each item in ascending order as one text with a leading space, cut to ``chars``.

    Every entry but the first takes its separator at least (a NULL number takes nothing more), so later documents
    than that can't appear in the cut text; they are left behind before the shuffle and the collected list is
    bounded. With ``chars`` None the list is whole. Repeated lines repeat the document unless ``distinct``.
    """
    last = 2**31 - 1 if chars is None else chars // len(LIST_SEPARATOR) + 1
    ranked = counts.withColumn(
        "_nth", F.row_number().over(Window.partitionBy(item).orderBy(F.col("doc_num").asc_nulls_first()))
    ).where(F.col("_nth") <= last)
    text = F.coalesce(F.col("doc_num").cast("string"), F.lit(""))
    # The count is used either way, so that both lists of one aggregate share its exchange.
    repeats = F.least(F.col("n_lines"), F.lit(1 if distinct else last)).cast("int")
    listed = ranked.groupBy(item).agg(
        F.sort_array(F.collect_list(F.struct("_nth", F.array_repeat(text, repeats).alias("docs")))).alias("_docs")
    )
    joined = F.array_join(F.flatten(F.col("_docs.docs")), LIST_SEPARATOR)
    text = F.concat(F.lit(" "), joined)
    return listed.select(item, (text if chars is None else F.substring(text, 1, chars)).alias("doc_list"))
