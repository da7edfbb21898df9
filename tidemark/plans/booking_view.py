"""The wide booking projection: a star join with delivery-penalty metrics, 104 columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import metrics as M
from tidemark.functions.clock import Clock, as_clock
from tidemark.operators.filters import not_cancelled
from tidemark.operators.joins import (
    assert_unique_key,
    contains_join,
    enrich_booking,
    flag_exists,
    header_lines,
    token_hits,
    valid_ref_or_blank,
)
from tidemark.operators.shuffled import shuffled
from tidemark.plans.detectors import Tables

# The output columns in order. Those not computed below are booking columns passed through.
COLUMNS = """
    disable_row code booking_date booking_id so_ref client_name client_code carrier_name
    island island_d if_inter_island verification_tat pod_tat actual_date_rec_initial carrier_code
    plate_number vehicle_type_cap delivery_status delivery_date delivery_date_pod no_of_drops trip_type
    received_by client_received initial_received actual_received date_returned pod_in_charge verified_date
    ptf_no date_forwarded billing_deadline billing_status service_type si_no billing_team sob_number
    forward_load back_load type_of_accessorial time_in_empty_dem time_out_empty_dem verified_empty_dem
    time_in_loaded_dem time_out_loaded_dem verified_loaded_dem time_in_adv_loading penalties_manual
    day_of_week time_in time_out total_no_exceed odo_in odo_out total_usage client_sub_status
    client_sub_overdue client_penalty payment_status submit_deadline overdue_days carrier_penalty
    waived_days holiday_days lost_penalty total_sub_penalties waived perc_penalty approved_by
    total_penalty_waived billing_num tp_num pricing_num cdc dcd gross_trucker_rates group_project
    attachment delivery_origin destination remarks other_pod_doc remarks_pod status_detail bt_remarks
    destination_client remarks2 doc_num trip_ticket_no waybill_no shipment_no delivery_receipt_no
    series_no outlet_no cbm si_dr_no delivery_mode source_whse so_no name_customer category_dr id_number
    approval_status total_inv_amount
""".split()

# The columns that are cast to long text.
LONG_TEXT = COLUMNS[COLUMNS.index("group_project"):]

COMPUTED = set(
    """
    disable_row code so_ref client_name carrier_name client_sub_status client_sub_overdue client_penalty
    payment_status submit_deadline overdue_days carrier_penalty lost_penalty total_sub_penalties
    total_penalty_waived billing_num tp_num pricing_num cdc dcd gross_trucker_rates group_project
    """.split()
)
POD_COLUMNS = [c for c in COLUMNS if c not in COMPUTED]


def row_disabled_flag(df: DataFrame, tables: Tables, match: str = "substring") -> DataFrame:
    """Add ``disable_row``: 'Y' when the booking has a live receivable and a live payable invoice.

    A payable belongs to a booking by line item, or because its reference occurs in the booking's cell: anywhere
    in the squeezed cell (``substring``) or as one of its tokens (``token``).
    """
    receivable = header_lines(not_cancelled(tables["receivable_head"]), tables["receivable_line"])
    payable = not_cancelled(tables["payable_head"])
    in_cell = contains_join if match == "substring" else token_hits
    cells = in_cell(tables["tp"], "pv_no", payable, "pv_no")
    flagged = flag_exists(df, "booking_id", receivable.select("item"), "_receivable")
    flagged = flag_exists(flagged, "booking_id", header_lines(payable, tables["payable_line"]).select("item"), "_payable")
    flagged = flag_exists(flagged, "tp_pv_no", cells, "_in_cell")
    both = F.col("_receivable") & (F.col("_payable") | F.col("_in_cell"))
    return flagged.withColumn("disable_row", F.when(both, "Y").otherwise("N")).drop(
        "_receivable", "_payable", "_in_cell"
    )


def carrier_total(df: DataFrame) -> DataFrame:
    """Add ``_carrier_total``; NULL as soon as one of its terms is."""
    vat = F.col("carrier_vat_status")
    extras = F.col("pricing_addtl_drop") + F.col("pricing_boom_truck") + F.col("pricing_manpower")
    terms = [F.col("pricing_gross_rates"), F.col("pricing_demurrage2"), extras + F.col("pricing_backload")]
    total = M.net_of_vat(terms[0], vat) + M.net_of_vat(terms[1], vat) + M.net_of_vat(terms[2], vat)
    return df.withColumn("_carrier_total", total)


def penalty_metrics(
    df: DataFrame,
    as_of: Clock,
    combine=M.total_sub_penalties,
    waive=M.penalty_waived,
) -> DataFrame:
    """Add the metric columns in stages, each shared term once."""
    c = F.col
    zero = lambda name: F.coalesce(c(name), F.lit(0))
    staged = carrier_total(df).withColumns(
        {
            "cdc": zero("client_cdc"),
            "dcd": zero("client_dcd"),
            "client_sub_status": M.submission_status(c("client_received")),
        }
    )
    staged = staged.withColumns(
        {
            "client_sub_overdue": M.client_sub_overdue(
                c("delivery_date"), c("client_received"), zero("waived_days"), c("dcd")
            ),
            "submit_deadline": M.submit_deadline(c("delivery_date"), c("cdc")),
        }
    )
    staged = staged.withColumns(
        {
            "client_penalty": M.client_penalty(c("client_sub_overdue")),
            "overdue_days": M.overdue_days(
                c("actual_received"), c("submit_deadline"), zero("holiday_days"), as_of
            ),
        }
    )
    staged = staged.withColumn(
        "payment_status", M.payment_status(c("overdue_days"), c("submit_deadline").isNotNull())
    )
    staged = staged.withColumns(
        {
            "carrier_penalty": M.carrier_penalty(c("payment_status"), c("overdue_days")),
            "lost_penalty": M.lost_penalty(
                c("payment_status"), c("initial_received"), c("delivery_date"), c("_carrier_total")
            ),
        }
    )
    staged = staged.withColumn(
        "total_sub_penalties",
        combine(c("client_penalty"), c("carrier_penalty"), c("lost_penalty"), zero("penalties_manual")),
    )
    return staged.withColumn("total_penalty_waived", waive(c("total_sub_penalties"), zero("perc_penalty")))


def build_booking_view(
    tables: Tables,
    as_of: Clock | None = None,
    ids: DataFrame | None = None,
    match: str = "substring",
    unique: bool = False,
    combine=M.total_sub_penalties,
    waive=M.penalty_waived,
) -> DataFrame:
    """All bookings, or those whose id is in ``ids`` (one column ``booking_id``)."""
    clock = as_clock(as_of)
    pod = tables["pod"]
    if ids is not None:
        pod = pod.join(shuffled(ids.select("booking_id")), "booking_id", "left_semi")
    star = enrich_booking(pod, tables["billing"], tables["tp"], tables["pricing"], tables["partner"])
    if unique:
        star = assert_unique_key(star, "booking_id")
    live_orders = not_cancelled(tables["order_head"])
    star = valid_ref_or_blank(star, "billing_so_ref", live_orders)
    star = penalty_metrics(row_disabled_flag(star, tables, match), clock, combine, waive)

    c = F.col
    text = lambda name: F.coalesce(c(name), F.lit(""))
    computed = {
        "code": c("booking_id"),
        "so_ref": c("billing_so_ref"),
        "client_name": c("client_name"),
        "carrier_name": c("carrier_name"),
        "day_of_week": M.weekday_or_stored(c("day_of_week"), c("booking_date")),
        "waived": M.flag_or_n(c("waived")),
        "billing_num": text("billing_code"),
        "tp_num": text("tp_code"),
        "pricing_num": text("pricing_code"),
        "gross_trucker_rates": F.coalesce(c("pricing_gross_rates"), F.lit(0.0)),
        "group_project": text("client_group_location"),
    }
    out = [computed.get(name, c(name)) for name in COLUMNS]
    cast = [o.cast("string") if name in LONG_TEXT else o for name, o in zip(COLUMNS, out)]
    return star.select(*[o.alias(name) for name, o in zip(COLUMNS, cast)])
