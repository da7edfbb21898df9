"""Delivery-penalty metrics as plain column expressions.

Day counts are *deadline minus event*, so negative means late. The inputs are those of the current formulas
(values, not 0/1 flags), the arithmetic is that of the published inline ones. ``total_sub_penalties`` and
``penalty_waived`` have no published body; the sum and the product used here can be replaced by the caller.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemark.functions.clock import Clock, as_clock
from tidemark.functions.text import is_blank, is_blank_date

# Fixed values.
PENALTY_PER_DAY = 200
LOST_FACTOR = 2
LATE_FLOOR = -13
VAT_DIVISOR = 1.12


def weekday_or_stored(stored: Column, day: Column) -> Column:
    return F.when(is_blank(stored), F.date_format(day, "EEEE")).otherwise(stored)


def submission_status(received: Column) -> Column:
    return F.when(is_blank_date(received), "PENDING").otherwise("SUBMITTED")


def flag_or_n(flag: Column) -> Column:
    return F.when(is_blank(flag), "N").otherwise(flag)


def net_of_vat(amount: Column, vat_status: Column) -> Column:
    """The amount, or the amount without tax for status N; NULL for other codes."""
    status = F.coalesce(vat_status, F.lit("Y"))
    return F.when(status == "Y", amount).when(status == "N", amount / F.lit(VAT_DIVISOR))


def client_sub_overdue(delivery: Column, received: Column, waived_days: Column, dcd: Column) -> Column:
    known = ~is_blank_date(delivery) & ~is_blank_date(received)
    days = F.datediff(delivery, received) + dcd.cast("int") + waived_days.cast("int")
    return F.when(known, days).otherwise(0)


def client_penalty(overdue: Column) -> Column:
    return F.when(overdue < 0, overdue * PENALTY_PER_DAY).otherwise(0)


def submit_deadline(delivery: Column, cdc: Column) -> Column:
    return F.when(~is_blank_date(delivery), F.date_add(delivery.cast("date"), cdc.cast("int")))


def overdue_days(actual: Column, deadline: Column, holidays: Column, as_of: Clock | None = None) -> Column:
    """Days left at the actual receipt, or at ``as_of`` while nothing was received; 0 without a deadline."""
    reached = F.when(is_blank_date(actual), as_clock(as_of).day()).otherwise(actual.cast("date"))
    days = F.datediff(F.date_add(deadline, holidays.cast("int")), reached)
    return F.when(deadline.isNotNull(), days).otherwise(0)


def payment_status(overdue: Column, computable: Column | None = None) -> Column:
    """Ontime, Late (down to -13 days) or Lost; '' when there is nothing to compute from."""
    graded = F.when(overdue >= 0, "Ontime").when(overdue >= LATE_FLOOR, "Late").when(overdue < LATE_FLOOR, "Lost")
    if computable is not None:
        graded = F.when(computable, graded)
    return F.coalesce(graded, F.lit(""))


def carrier_penalty(status: Column, overdue: Column) -> Column:
    return F.when(status == "Late", overdue * PENALTY_PER_DAY).otherwise(0)


def lost_penalty(status: Column, initial: Column, delivery: Column, carrier_total: Column) -> Column:
    """Twice the carrier's total, negative, for a lost delivery.

    ``initial`` and ``delivery`` keep the call's shape; the status already implies a delivery date.
    """
    total = F.coalesce(carrier_total, F.lit(0.0))
    return F.when((status == "Lost") & (total != 0), -(total * LOST_FACTOR)).otherwise(F.lit(0.0))


def total_sub_penalties(client: Column, carrier: Column, lost: Column, manual: Column) -> Column:
    return client + carrier + lost + manual


def penalty_waived(total: Column, share: Column) -> Column:
    return total * share
