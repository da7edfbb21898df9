"""Reconciliations between the older per-tab read models; they are not part of the live detector set.

Column names are parameters with neutral defaults. Each gives distinct (id, serial), level-triggered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.clock import Clock, as_clock
from tidemark.functions.text import concat_text, text_has
from tidemark.operators.joins import not_in
from tidemark.operators.reconcile import reconcile_numeric, reconcile_text

# The columns compared, as (first table, second table).
SUMMARY_BILLING = [
    ("billing_status", "billing_status"),
    ("invoice_no", "invoice_no"),
    ("so_ref", "so_ref"),
    ("ar_refs", "doc_num"),
]
PRICING_BILLING = [
    ("gross_client_rates_tax", "gross_initial_rate"),
    ("demurrage", "demurrage"),
    ("total_addtl_charges", "add_charges"),
]
PRICING_TP = [
    ("gross_trucker_rates", "gross_trucker_rates"),
    ("gross_trucker_rates_tax", "gross_trucker_rates_n"),
    ("rate_basis_t", "rate_basis"),
    ("demurrage2", "demurrage"),
    ("addtl_drop2", "addtl_drop"),
    ("boom_truck2", "boom_truck"),
    ("manpower2", "manpower"),
    ("backload2", "backload"),
    ("total_addtl_charges2", "addtl_charges"),
    ("demurrage3", "demurrage_n"),
    ("addtl_charges", "addtl_charges_n"),
]
BILLABLE = ("Verified", "ForAdvanceBilling")
PAYABLE = ("Verified",)
# Fixed value: the source compares the status as a text of at most this length.
STATUS_CHARS = 100


def _stamped(ids: DataFrame, prefix: str, as_of: Clock) -> DataFrame:
    return ids.select("id", concat_text(prefix, as_clock(as_of).stamp()).alias("serial"))


def detect_sbdi(summary: DataFrame, billing: DataFrame, as_of: Clock) -> DataFrame:
    """Summary and billing disagree on a text."""
    return _stamped(reconcile_text(summary, billing, "booking_id", "booking_id", SUMMARY_BILLING), "SBDI-", as_of)


def detect_bpdi(pricing: DataFrame, billing: DataFrame, as_of: Clock) -> DataFrame:
    """Pricing and billing disagree on a number."""
    ids = reconcile_numeric(pricing, billing, "booking_id", "booking_id", PRICING_BILLING)
    return _stamped(ids, "B-BTPDI-", as_of)


def detect_tpdi(pricing: DataFrame, tp: DataFrame, as_of: Clock) -> DataFrame:
    """Pricing and carrier payables disagree on a number."""
    return _stamped(reconcile_numeric(pricing, tp, "booking_id", "booking_id", PRICING_TP), "T-BTPDI-", as_of)


def _verified_absent(
    pod: DataFrame, side: DataFrame, extract: DataFrame, needles: tuple[str, ...], status_chars: int | None
) -> DataFrame:
    status = F.col("status_detail") if status_chars is None else F.substring("status_detail", 1, status_chars)
    wanted = pod.where(text_has(status, *needles) & F.col("booking_id").isNotNull())
    absent = not_in(wanted.select("booking_id"), "booking_id", extract, "booking_id")
    ids = absent.join(side.select("booking_id"), "booking_id", "left_semi").distinct()
    return ids.withColumnRenamed("booking_id", "id")


def detect_bvnr(
    pod: DataFrame, billing: DataFrame, extract: DataFrame, as_of: Clock, status_chars: int | None = STATUS_CHARS
) -> DataFrame:
    """Bookings ready to bill that the billing extract lacks; one NULL key there silences the detector.

    The status is searched in its first ``status_chars`` characters, or whole with None.
    """
    return _stamped(_verified_absent(pod, billing, extract, BILLABLE, status_chars), "B-TBVNR-", as_of)


def detect_tvnr(
    pod: DataFrame, tp: DataFrame, extract: DataFrame, as_of: Clock, status_chars: int | None = STATUS_CHARS
) -> DataFrame:
    """Verified bookings that the carrier extract lacks; its NULL keys are filtered out."""
    known = extract.where(F.col("booking_id").isNotNull())
    return _stamped(_verified_absent(pod, tp, known, PAYABLE, status_chars), "T-TBVNR-", as_of)
