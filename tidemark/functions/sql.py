"""The text and metric functions under names that SQL texts call, with bodies in SQL.

Spark puts a body into the plan that calls it, so that it is optimised and compiled like the same expression written out.
``booking_penalties`` and ``cell_tokens`` return tables: the first is one row of all metrics, for ``LATERAL`` joins.
``metrics`` holds the DataFrame forms; both give the same values.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidemark.functions.metrics import LATE_FLOOR, LOST_FACTOR, PENALTY_PER_DAY, VAT_DIVISOR
from tidemark.functions.text import EMPTY_DATE

# In order of use: a body may call only functions above it.
SCALARS = {
    "blank_text(c STRING) RETURNS BOOLEAN": "coalesce(trim(c), '') = ''",
    "blank_day(c DATE) RETURNS BOOLEAN": f"c IS NULL OR c = DATE'{EMPTY_DATE}'",
    "cell_has(cell STRING, value STRING) RETURNS BOOLEAN":
        "coalesce(array_contains(transform(split(cell, ','), t -> trim(t)), value), false)",
    "number_of(c STRING) RETURNS DOUBLE": "nullif(try_cast(translate(c, ',', '') AS DOUBLE), DOUBLE('NaN'))",
    "weekday_or_stored(stored STRING, day DATE) RETURNS STRING":
        "CASE WHEN blank_text(stored) THEN date_format(day, 'EEEE') ELSE stored END",
    "submission_status(received DATE) RETURNS STRING": "CASE WHEN blank_day(received) THEN 'PENDING' ELSE 'SUBMITTED' END",
    "flag_or_n(flag STRING) RETURNS STRING": "CASE WHEN blank_text(flag) THEN 'N' ELSE flag END",
    "net_of_vat(amount DOUBLE, vat_status STRING) RETURNS DOUBLE":
        f"CASE coalesce(vat_status, 'Y') WHEN 'Y' THEN amount WHEN 'N' THEN amount / DOUBLE('{VAT_DIVISOR}') END",
    "client_sub_overdue(delivery DATE, received DATE, waived_days INT, dcd INT) RETURNS INT":
        "CASE WHEN NOT blank_day(delivery) AND NOT blank_day(received) "
        "THEN datediff(delivery, received) + dcd + waived_days ELSE 0 END",
    "client_penalty(overdue INT) RETURNS INT": f"CASE WHEN overdue < 0 THEN overdue * {PENALTY_PER_DAY} ELSE 0 END",
    "submit_deadline(delivery DATE, cdc INT) RETURNS DATE": "CASE WHEN NOT blank_day(delivery) THEN date_add(delivery, cdc) END",
    "overdue_days(actual DATE, deadline DATE, holidays INT, as_of DATE) RETURNS INT":
        "CASE WHEN deadline IS NOT NULL THEN datediff(date_add(deadline, holidays), "
        "CASE WHEN blank_day(actual) THEN as_of ELSE actual END) ELSE 0 END",
    "payment_status(overdue INT, computable BOOLEAN) RETURNS STRING":
        "CASE WHEN NOT coalesce(computable, false) OR overdue IS NULL THEN '' "
        f"WHEN overdue >= 0 THEN 'Ontime' WHEN overdue >= {LATE_FLOOR} THEN 'Late' ELSE 'Lost' END",
    "carrier_penalty(status STRING, overdue INT) RETURNS INT":
        f"CASE WHEN status = 'Late' THEN overdue * {PENALTY_PER_DAY} ELSE 0 END",
    "lost_penalty(status STRING, carrier_total DOUBLE) RETURNS DOUBLE":
        f"CASE WHEN status = 'Lost' AND carrier_total <> 0 THEN -(carrier_total * {LOST_FACTOR}) ELSE 0D END",
    "total_sub_penalties(client INT, carrier INT, lost DOUBLE, manual DOUBLE) RETURNS DOUBLE":
        "client + carrier + lost + manual",
    "penalty_waived(total DOUBLE, share DOUBLE) RETURNS DOUBLE": "total * share",
}

TABLES = {
    "cell_tokens(cell STRING) RETURNS TABLE (position INT, token STRING)":
        "SELECT pos, trim(col) FROM posexplode(split(cell, ','))",
    """booking_penalties(delivery DATE, received DATE, actual DATE, waived_days INT, cdc INT, dcd INT, holidays INT,
        carrier_total DOUBLE, manual DOUBLE, share DOUBLE, as_of DATE)
        RETURNS TABLE (client_sub_overdue INT, client_penalty INT, submit_deadline DATE, overdue_days INT,
        payment_status STRING, carrier_penalty INT, lost_penalty DOUBLE, total_sub_penalties DOUBLE, total_penalty_waived DOUBLE)""":
        """SELECT late, client, deadline, days, status, carrier, lost, total, penalty_waived(total, coalesce(share, 0D))
        FROM (SELECT *, total_sub_penalties(client, carrier, lost, coalesce(manual, 0D)) AS total
        FROM (SELECT *, carrier_penalty(status, days) AS carrier, lost_penalty(status, carrier_total) AS lost
        FROM (SELECT *, payment_status(days, deadline IS NOT NULL) AS status
        FROM (SELECT *, client_penalty(late) AS client, overdue_days(actual, deadline, coalesce(holidays, 0), as_of) AS days
        FROM (SELECT client_sub_overdue(delivery, received, coalesce(waived_days, 0), coalesce(dcd, 0)) AS late,
            submit_deadline(delivery, coalesce(cdc, 0)) AS deadline)))))""",
}


def register_functions(spark: SparkSession) -> list[str]:
    """Make the functions known to the session's SQL texts, in place of earlier ones of the same names; returns the names."""
    for signature, body in (SCALARS | TABLES).items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
    return [signature.split("(")[0] for signature in SCALARS | TABLES]
