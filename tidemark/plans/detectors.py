"""Which booking ids need a refresh, and why: nine detectors, each giving distinct (id, serial).

Edge-triggered ones carry the document's own change stamp, so the ledger stops repeats. Level-triggered ones
carry the run's moment and return until the condition clears. With ``latest`` a detector may leave out events
that a newer event of the same id outranks.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.clock import Clock, as_clock, day_text
from tidemark.functions.text import concat_text, csv_size, is_blank, tokens
from tidemark.operators.aggregates import doc_counts, doc_list, duplicate_keys
from tidemark.operators.filters import changed_on, created_on, not_cancelled
from tidemark.operators.joins import (
    csv_ref_join,
    docnum_ref_join,
    header_lines,
    in_any,
    multivalue_join,
    not_exists,
    not_in,
    payment_to_invoice,
)
from tidemark.operators.merge import latest_per_id, with_stamp
from tidemark.operators.shuffled import shuffled

Tables = Mapping[str, DataFrame]


def document_serial(prefix: str, number: Column) -> Column:
    return concat_text(prefix, number, "-", day_text(F.col("update_date")), F.col("update_ts"))


def changed_heads(head: DataFrame, prefix: str, as_of: Clock, lookback_days: int) -> DataFrame:
    changed = changed_on(head, as_of, lookback_days)
    return with_stamp(changed.withColumn("serial", document_serial(prefix, F.col("doc_num"))))


def _items(head: DataFrame, line: DataFrame, latest: bool) -> DataFrame:
    """(id, serial) of the heads' line items."""
    found = header_lines(head, line).select(F.col("item").alias("id"), "serial", "stamp")
    return (latest_per_id(found) if latest else found.distinct()).select("id", "serial")


def detect_ap(tables: Tables, as_of: Clock, lookback_days: int = 0, latest: bool = False) -> DataFrame:
    """Payable invoices changed on the day, by reference number (a cell on either side) or by line item."""
    head = changed_heads(tables["payable_head"], "AP", as_of, lookback_days)
    return multivalue_join(head, tables["payable_line"], tables["tp"], latest=latest)


def detect_op(tables: Tables, as_of: Clock, lookback_days: int = 0, latest: bool = False) -> DataFrame:
    """Live payments changed on the day, of an invoice the read model lists as booked or as paid."""
    head = changed_heads(not_cancelled(tables["payment_head"], "not_y"), "OP", as_of, lookback_days)
    paid = payment_to_invoice(head, tables["payment_line"], tables["payable_head"])
    docs = paid.select("doc_num", "serial", "stamp")
    return csv_ref_join(tables["read_model"], docs, ["doc_refs", "paid_refs"], latest)


def detect_so(tables: Tables, as_of: Clock, lookback_days: int = 0, latest: bool = False) -> DataFrame:
    """Sales orders changed on the day, by line item or by the order number stored on the read model."""
    head = changed_heads(tables["order_head"], "SO", as_of, lookback_days)
    by_item = _items(head, tables["order_line"], latest)
    by_number = docnum_ref_join(head.select("doc_num", "serial", "stamp"), tables["read_model"], latest=latest)
    return by_item.unionByName(by_number).distinct()


def detect_ar(tables: Tables, as_of: Clock, lookback_days: int = 0, latest: bool = False) -> DataFrame:
    """Receivable invoices changed on the day, by line item."""
    head = changed_heads(tables["receivable_head"], "AR", as_of, lookback_days)
    return _items(head, tables["receivable_line"], latest)


def live_doc_counts(head: DataFrame, line: DataFrame) -> DataFrame:
    """Lines per (item, live document); a document without a number can neither be counted nor listed."""
    return doc_counts(header_lines(not_cancelled(head, "is_n").where(F.col("doc_num").isNotNull()), line))


def _listed_and_live(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """``rows`` with the number of documents each cell lists and how many of those are live.

    Joining by (item, document) keeps an item with very many documents spread out.
    """
    numbers = F.transform(tokens(F.col("ar_refs")), lambda t: t.try_cast("bigint"))
    listed = rows.select("*", F.explode_outer(F.array_distinct(numbers)).alias("doc_num"))
    # Built on the count, so that this use of the aggregate is the same as the others and shares their exchange.
    live = counts.select(F.col("item").alias("booking_id"), "doc_num", F.least("n_lines", F.lit(1)).alias("_live"))
    return (
        listed.join(shuffled(live), ["booking_id", "doc_num"], "left")
        .groupBy("booking_id", "ar_refs")
        .agg(F.count("*").alias("n_listed"), F.count("_live").alias("n_matched"))
    )


def _as_booking(lists: DataFrame, name: str) -> DataFrame:
    return lists.select(F.col("item").alias("booking_id"), F.col("doc_list").alias(name))


def stale_ids(rows: DataFrame, counts: DataFrame, legacy: bool = False, count_distinct: bool = False) -> DataFrame:
    """Ids of the bookings in ``rows`` (booking_id, ar_refs) whose list is stale by ``counts``."""
    stats = counts.groupBy(F.col("item").alias("booking_id")).agg(
        F.sum("n_lines").alias("n_lines"), F.count("*").alias("n_docs")
    )
    if legacy:
        rows = rows.join(shuffled(_as_booking(doc_list(counts, distinct=True), "_text")), "booking_id", "left")
        differs = F.rtrim("_text") != F.rtrim("ar_refs")
    else:
        rows = _listed_and_live(rows, counts)
        differs = (F.col("n_listed") != F.col("n_matched")) | (F.col("n_matched") != F.col("n_docs"))
    fewer = csv_size(F.col("ar_refs")) < (F.col("n_docs") if count_distinct else F.col("n_lines"))
    stale = rows.join(shuffled(stats), "booking_id").where(is_blank(F.col("ar_refs")) | (fewer & differs))
    return stale.select("booking_id").distinct()


def listed(ids: DataFrame, counts: DataFrame) -> DataFrame:
    """(booking_id, listed) of bookings, with the live documents that ``counts`` has of them."""
    return ids.join(shuffled(_as_booking(doc_list(counts), "listed")), "booking_id")


def detect_arnr(
    tables: Tables,
    as_of: Clock,
    lookback_days: int = 0,
    latest: bool = False,
    legacy: bool = False,
    count_distinct: bool = False,
) -> DataFrame:
    """Live receivable invoices exist, but the read model lists none, or fewer and different ones.

    Lists differ unless they hold the same numbers; ``legacy`` compares them as text instead. With
    ``count_distinct`` documents are counted rather than invoice lines.
    """
    counts = live_doc_counts(tables["receivable_head"], tables["receivable_line"])
    rows = tables["read_model"].select("booking_id", "ar_refs").distinct()
    stale = listed(stale_ids(rows, counts, legacy, count_distinct), counts)
    serial = concat_text("AR", F.col("listed"), "-NR-", as_clock(as_of).stamp())
    return stale.select(F.col("booking_id").alias("id"), serial.alias("serial"))


def detect_bn(tables: Tables, as_of: Clock, lookback_days: int = 0, latest: bool = False) -> DataFrame:
    """Items created on the day that are booked or priced, but absent from the read model."""
    items = created_on(tables["item"].where(F.col("item").isNotNull()), as_of, lookback_days)
    known = in_any(items, "item", (tables["pod"], "booking_id"), (tables["pricing"], "booking_id"))
    absent = not_exists(known, "item", tables["read_model"], "booking_id")
    serial = concat_text("BN-", day_text(F.col("create_date")), F.col("create_ts"))
    return absent.select(F.col("item").alias("id"), serial.alias("serial")).distinct()


def _level(ids: DataFrame, prefix: str, as_of: Clock) -> DataFrame:
    return ids.select(F.col("booking_id").alias("id"), concat_text(prefix, as_clock(as_of).stamp()).alias("serial"))


def detect_dup(tables: Tables, as_of: Clock, lookback_days: int = 0, latest: bool = False) -> DataFrame:
    """Keys the read model holds more than once; NULL is reported too."""
    return _level(duplicate_keys(tables["read_model"], "booking_id"), "DUP-", as_of)


def detect_ptf(tables: Tables, as_of: Clock, lookback_days: int = 0, latest: bool = False) -> DataFrame:
    """Bookings with a forwarding number that the read model shows blank."""
    numbered = tables["pod"].where(~is_blank(F.col("ptf_no")) & F.col("booking_id").isNotNull())
    blank = tables["read_model"].where(is_blank(F.col("ptf_no")) & F.col("booking_id").isNotNull())
    ids = numbered.select("booking_id").join(shuffled(blank.select("booking_id")), "booking_id", "left_semi")
    return _level(ids.distinct(), "PTF-", as_of)


def detect_missing(tables: Tables, as_of: Clock, lookback_days: int = 0, latest: bool = False) -> DataFrame:
    """Bookings the read model does not hold, by ``NOT IN``: one NULL key there silences the detector."""
    ids = not_in(tables["pod"].select("booking_id"), "booking_id", tables["read_model"], "booking_id")
    return _level(ids.distinct(), "MISSING-", as_of)


Detector = Callable[..., DataFrame]

# In the order in which their outputs are concatenated.
DETECTORS: dict[str, Detector] = {
    "AP": detect_ap,
    "OP": detect_op,
    "SO": detect_so,
    "AR": detect_ar,
    "ARNR": detect_arnr,
    "BN": detect_bn,
    "DUP": detect_dup,
    "PTF": detect_ptf,
    "MISSING": detect_missing,
}


def detect_levels(tables: Tables, as_of: Clock) -> DataFrame:
    """(id, serial, detector) of DUP, PTF and MISSING from one pass over the read model.

    The three ask different questions of the same two tables by the same key, so the read model is reduced to
    one row per key, the bookings likewise, and one join answers all three.
    """
    stamp = as_clock(as_of).stamp()
    model, pod = tables["read_model"], tables["pod"]
    seen = model.groupBy("booking_id").agg(
        F.count("*").alias("n_rows"), F.max(is_blank(F.col("ptf_no"))).alias("blank_ptf")
    )
    booked = pod.groupBy("booking_id").agg(F.max(~is_blank(F.col("ptf_no"))).alias("has_ptf"))
    nulls = model.where(F.col("booking_id").isNull()).limit(1).agg(F.count("*")).scalar()
    some = model.select("booking_id").limit(1).agg(F.count("*")).scalar()
    marked_seen = seen.withColumn("_seen", F.lit(True))
    both = marked_seen.join(shuffled(booked.withColumn("_booked", F.lit(True))), "booking_id", "full")
    on = lambda name: F.coalesce(F.col(name), F.lit(False))
    missing = on("_booked") & ~on("_seen") & (nulls == 0) & (F.col("booking_id").isNotNull() | (some == 0))
    facts = [
        ("DUP", F.coalesce(F.col("n_rows") > 1, F.lit(False))),
        ("PTF", on("has_ptf") & on("blank_ptf") & F.col("booking_id").isNotNull()),
        ("MISSING", missing),
    ]
    found = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in facts]))
    return both.select(F.col("booking_id").alias("id"), F.explode(found).alias("detector")).select(
        "id", concat_text(F.col("detector"), "-", stamp).alias("serial"), "detector"
    )
