"""The engine's input tables, as views over the given TPC-H-like tables.

Cells with several values are made from their own row, so no key's rows are gathered to build one. The views carry
what real tables do: NULL and blank keys and cells, tokens with spaces, unreadable numbers, repeated keys.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.aggregates import doc_list
from tidemark.operators.shuffled import shuffled
from tidemark.plans.booking_view import POD_COLUMNS
from tidemark.plans.detectors import live_doc_counts
from tidemark.plans.drift import PRICING_BILLING, PRICING_TP
from tidemark.schemas import TABLES
from tidemark.session import shared_dir

AS_OF = "1998-06-01"
LOOKBACK = 30
# Days from the payments' year back to that of the documents.
PAYMENT_SHIFT = 9371

# Documents of each kind, and the lines of each.
KINDS = {"payable_head": "doc_num % 3 <> 2", "order_head": "doc_num % 3 <> 0", "receivable_head": "doc_num % 3 <> 1"}
PLAIN_POD = {
    "booking_id": "CAST(p_partkey AS STRING)",
    "booking_date": "date_add(DATE'1998-01-01', CAST(p_partkey % 200 AS INT))",
    "client_code": "concat('C', p_partkey)",
    "carrier_code": "concat('S', p_partkey % 120)",
    "delivery_date": "CASE WHEN p_partkey % 23 <> 0 THEN "
    "date_add(DATE'1998-01-01', CAST(p_partkey % 200 + p_partkey % 15 AS INT)) END",
    "client_received": "CASE WHEN p_partkey % 29 = 0 THEN DATE'1900-01-01' WHEN p_partkey % 4 <> 0 THEN "
    "date_add(DATE'1998-01-01', CAST(p_partkey % 200 + p_partkey % 20 AS INT)) END",
    "initial_received": "CASE WHEN p_partkey % 5 <> 0 THEN "
    "date_add(DATE'1998-01-01', CAST(p_partkey % 200 + p_partkey % 30 AS INT)) END",
    "actual_received": "CASE WHEN p_partkey % 3 <> 0 THEN "
    "date_add(DATE'1998-01-01', CAST(p_partkey % 200 + p_partkey * 7 % 50 AS INT)) END",
    "waived_days": "CASE WHEN p_partkey % 8 <> 0 THEN CAST(p_partkey % 3 AS INT) END",
    "holiday_days": "CAST(p_partkey % 2 AS INT)",
    "penalties_manual": "CASE WHEN p_partkey % 6 <> 0 THEN p_partkey % 100 * 1.5D END",
    "waived": "CASE p_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'Y' WHEN 2 THEN ' ' END",
    "perc_penalty": "CASE WHEN p_partkey % 7 <> 0 THEN p_partkey % 10 / 10.0D END",
    "day_of_week": "CASE p_partkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'Payday' END",
    "ptf_no": "CASE WHEN p_partkey % 14 <> 0 THEN p_brand END",
    "status_detail": "CASE p_partkey % 4 WHEN 0 THEN 'Verified' WHEN 1 THEN 'ForAdvanceBilling, late' "
    "WHEN 2 THEN 'Pending' END",
}


# Declared rather than inferred, which would cost a job per read.
GIVEN = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(GIVEN[name]).parquet(f"{sf_dir}/{name}.parquet")


def heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, of every kind."""
    day = "CAST(o_orderdate AS DATE)"
    return given(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS doc_entry",
        "o_orderkey AS doc_num",
        f"{day} AS create_date",
        f"date_add({day}, CAST(o_orderkey % 3 AS INT)) AS update_date",
        "CAST(o_orderkey * 7919 % 24 * 10000 + o_orderkey % 60 * 100 AS INT) AS update_ts",
        "CASE WHEN o_orderstatus = 'P' THEN 'Y' WHEN o_orderkey % 11 = 0 THEN 'C' WHEN o_orderkey % 13 <> 0 THEN 'N' END AS cancelled",
        """CASE WHEN o_orderkey % 5 = 0 THEN concat('PV', o_orderkey, ' , PV', o_orderkey + 1)
                WHEN o_orderkey % 7 = 0 THEN NULL
                WHEN o_orderkey % 1009 = 0 THEN ''
                ELSE concat('PV', o_orderkey) END AS pv_no""",
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS doc_entry", "CAST(l_partkey AS STRING) AS item"
    )


def payable_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth booking is on no payable's line: only a reference in its cell can name it."""
    return lines(spark, sf_dir).where("CAST(item AS BIGINT) % 5 <> 0")


def receivable_line(spark: SparkSession, sf_dir: str, of: str = "l_partkey % 7 <> 0") -> DataFrame:
    """Every seventh booking has no receivable, and each document's first line is there twice."""
    given_lines = given(spark, sf_dir, "lineitem").where(of)
    both = given_lines.unionByName(given_lines.where("l_linenumber = 1"))
    return both.selectExpr("l_orderkey AS doc_entry", "CAST(l_partkey AS STRING) AS item")


def pod(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = {
        c: f"concat('{c}-', p_partkey % {3 + i % 11})" for i, c in enumerate(POD_COLUMNS) if c not in PLAIN_POD
    }
    columns = {c: PLAIN_POD.get(c) or text[c] for c in POD_COLUMNS}
    return given(spark, sf_dir, "part").selectExpr(*[f"{e} AS {c}" for c, e in columns.items()])


def tp(spark: SparkSession, sf_dir: str) -> DataFrame:
    many = "transform(sequence(0, p_size % 5), i -> concat('PV', p_partkey * 7 + i * 3))"
    return given(spark, sf_dir, "part").selectExpr(
        "CAST(p_partkey AS STRING) AS booking_id",
        "concat('T', p_partkey) AS code",
        f"""CASE WHEN p_partkey % 13 = 0 THEN ''
                 WHEN p_partkey % 17 = 0 THEN NULL
                 WHEN p_partkey % 7 = 0 THEN concat('PV', p_partkey * 7 + 1)
                 WHEN p_partkey % 3 = 0 THEN array_join({many}, ' , ')
                 ELSE array_join({many}, ', ') END AS pv_no""",
    )


def billing(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = given(spark, sf_dir, "part").where("p_partkey % 6 <> 0")
    return part.unionByName(part.where("p_partkey % 101 = 0")).selectExpr(
        "CAST(p_partkey AS STRING) AS booking_id",
        "concat('B', p_partkey) AS code",
        "CASE WHEN p_partkey % 9 = 0 THEN 'n/a' ELSE CAST(p_partkey * 8 AS STRING) END AS so_ref",
    )


def pricing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "part").where("p_partkey % 8 <> 0").selectExpr(
        "CAST(p_partkey AS STRING) AS booking_id",
        "CASE WHEN p_partkey % 9 <> 0 THEN concat('R', p_partkey) END AS code",
        "p_retailprice AS gross_rates",
        "CASE WHEN p_partkey % 31 <> 0 THEN p_partkey % 50 * 1.0D END AS demurrage2",
        "p_partkey % 3 * 10.0D AS addtl_drop",
        "p_partkey % 5 * 2.5D AS boom_truck",
        "p_partkey % 7 * 4.0D AS manpower",
        "p_size * 1.0D AS backload",
    )


def partner(spark: SparkSession, sf_dir: str) -> DataFrame:
    clients = given(spark, sf_dir, "customer").selectExpr(
        "concat('C', c_custkey) AS code",
        "c_name AS name",
        "CAST(c_custkey % 15 AS INT) AS cdc",
        "CASE WHEN c_custkey % 12 <> 0 THEN CAST(c_custkey % 7 AS INT) END AS dcd",
        "c_mktsegment AS group_location",
        "CAST(NULL AS STRING) AS vat_status",
    )
    carriers = given(spark, sf_dir, "supplier").selectExpr(
        "concat('S', s_suppkey) AS code",
        "s_name AS name",
        "CAST(NULL AS INT) AS cdc",
        "CAST(NULL AS INT) AS dcd",
        "CAST(NULL AS STRING) AS group_location",
        "CASE s_suppkey % 4 WHEN 0 THEN 'N' WHEN 1 THEN 'Y' WHEN 2 THEN 'X' END AS vat_status",
    )
    return clients.unionByName(carriers)


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "part").selectExpr(
        "CASE WHEN p_partkey % 50 <> 7 THEN CAST(p_partkey AS STRING) END AS item",
        "date_add(DATE'1998-04-01', CAST(p_partkey % 100 AS INT)) AS create_date",
        "CAST(p_partkey * 7919 % 24 * 10000 + p_partkey % 60 * 100 AS INT) AS create_ts",
    )


def payment_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = f"date_sub(CAST(ts AS DATE), {PAYMENT_SHIFT})"
    return given(spark, sf_dir, "events").where("event_type = 'purchase'").selectExpr(
        "event_id AS doc_entry",
        "event_id AS doc_num",
        f"{day} AS create_date",
        f"date_add({day}, CAST(event_id % 2 AS INT)) AS update_date",
        "hour(ts) * 10000 + minute(ts) * 100 AS update_ts",
        "CASE WHEN event_id % 9 = 0 THEN 'Y' WHEN event_id % 7 = 0 THEN 'C' WHEN event_id % 10 <> 0 THEN 'N' END AS cancelled",
    )


def payment_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "events").where("event_type = 'purchase'").selectExpr(
        "event_id AS doc_num", "explode(array(event_id, event_id + 7)) AS doc_entry"
    )


_STORED: dict[tuple[str, str], str] = {}


def read_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The read model as a stored table, which is what the engine keeps; written once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STORED:
        path = f"{shared_dir(spark)}/read-model-{uuid.uuid4().hex}"
        _derived_read_model(spark, sf_dir).write.parquet(path)
        _STORED[key] = path
    return spark.read.schema(TABLES["read_model"]).parquet(_STORED[key])


def _derived_read_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth booking is absent, every 97th of the rest is there twice, the lists are partly stale.

    Some lists have the right numbers in another order, or as many numbers as there are documents, but not the same.
    """
    part = given(spark, sf_dir, "part").where("p_partkey % 10 <> 0")
    part = part.unionByName(part.where("p_partkey % 97 = 0"))
    receivables = heads(spark, sf_dir).where(KINDS["receivable_head"])
    listed = doc_list(live_doc_counts(receivables, receivable_line(spark, sf_dir)), distinct=True)
    rows = part.withColumn("booking_id", F.col("p_partkey").cast("string"))
    return rows.join(shuffled(listed.withColumnRenamed("item", "booking_id")), "booking_id", "left").selectExpr(
        "booking_id",
        "CASE WHEN p_partkey % 19 = 0 THEN 'n/a' ELSE CAST(p_partkey * 7 AS STRING) END AS so_ref",
        """array_join(transform(sequence(0, p_size % 4), i -> CAST(p_partkey * 5 + i * 11 AS STRING)), ', ')
           AS doc_refs""",
        "CASE WHEN p_partkey % 2 = 0 THEN concat(p_partkey * 5 + 1, ' ,n/a') END AS paid_refs",
        """CASE p_partkey % 25 WHEN 1 THEN NULL WHEN 2 THEN ' ' WHEN 3 THEN doc_list
           WHEN 4 THEN array_join(reverse(split(trim(doc_list), ', ')), ', ')
           WHEN 6 THEN regexp_replace(trim(doc_list), '^[0-9]+', '7')
           ELSE CASE p_partkey % 5 WHEN 1 THEN NULL WHEN 2 THEN ' ' WHEN 3 THEN doc_list
           ELSE concat(p_partkey * 3, ', ', p_partkey * 3 + 1) END END AS ar_refs""",
        "CASE WHEN p_partkey % 11 = 0 THEN ' ' WHEN p_partkey % 22 = 1 THEN NULL ELSE p_brand END AS ptf_no",
    )


def rates_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "part").selectExpr(
        "CAST(p_partkey AS STRING) AS booking_id",
        "CASE WHEN p_partkey % 5 = 0 THEN 'NaN' ELSE CAST(p_size AS STRING) END AS amount",
        "CASE WHEN p_partkey % 7 = 0 THEN 'NaN' WHEN p_partkey % 3 = 0 THEN NULL ELSE p_brand END AS addl_amount",
    )


class Tables(Mapping):
    """The engine's tables by role, each access a new read.

    Reads of their own keep the plans free of self-joins, whose columns the analyzer would rename over and over;
    equal exchanges are still shared when the plan runs.
    """

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        makers = (pod, tp, billing, pricing, partner, payment_head, payment_line, read_model, rates_staging, payable_line, receivable_line)
        self._makers = {make.__name__: make for make in makers} | {"item": items}
        self._makers |= {"order_line": lines}
        self._makers |= {role: lambda spark, sf_dir, of=of: heads(spark, sf_dir).where(of) for role, of in KINDS.items()}
        self._source = (spark, sf_dir)

    def replaced(self, **makers) -> Tables:
        """These tables, but some made by functions of their own."""
        other = Tables(*self._source)
        other._makers = self._makers | {name: lambda *_, make=make: make() for name, make in makers.items()}
        return other

    def __getitem__(self, name: str) -> DataFrame:
        return self._makers[name](*self._source)

    def __iter__(self):
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir)


def whole_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The same, but every document is a sales order and a receivable, and no line of theirs is left out."""
    every = lambda: heads(spark, sf_dir)
    line = lambda: receivable_line(spark, sf_dir, "true")
    return tables(spark, sf_dir).replaced(order_head=every, receivable_head=every, receivable_line=line)


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As already processed: receivable events of every third booking, two level events of every fourth."""
    docs = heads(spark, sf_dir).join(shuffled(lines(spark, sf_dir)), "doc_entry").where("CAST(item AS BIGINT) % 3 = 0")
    edge = docs.selectExpr(
        "item AS id", "concat('AR', doc_num, '-', date_format(update_date, 'yyyyMMdd'), update_ts) AS serial"
    )
    level = given(spark, sf_dir, "part").where("p_partkey % 4 = 0").selectExpr(
        "CAST(p_partkey AS STRING) AS id",
        "explode(array('MISSING-19980601000000', 'PTF-19980601000000')) AS serial",
    )
    return edge.distinct().unionByName(level)


def message_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Client messages: views register, signups clean up, clicks ask to unlock, purchases update, errors are junk."""
    k = "CAST(get_json_object(props, '$.k') AS INT)"
    junk = ["", "[]", "{}", "null", '"text"', "12", '{"type":', '[{"type":"MESSAGE"}]', '{"type":"MESSAGE"}', '{"a":1} x']
    cases = " ".join(f"WHEN {i} THEN '{text}'" for i, text in enumerate(junk))
    client = """'"data":{"clientId":"', user_id, '","userName":"u', user_id, '"'"""
    prop = f"""',"prop":{{"group":"', element_at(array('pod', 'billing', 'tp', 'pricing'), {k} % 4 + 1), '"'"""
    head = lambda kind, event: f"""'{{"sessionId":"s', user_id, '","type":"{kind}","event":"{event}",'"""
    ids, one = f"""',"ids":["', {k}, '"]}}}}}}'""", f"""',"id":"', {k}, '"}}}}}}'"""
    return given(spark, sf_dir, "events").selectExpr(
        "event_id",
        "ts",
        # As a generator's row, the text is made once, like a stored column.
        f"""explode(array(CASE event_type
            WHEN 'view' THEN concat({head('MESSAGE', 'REGISTRATION')}, {client}, {prop}, {ids})
            WHEN 'signup' THEN concat({head('MESSAGE', 'CLEAN_UP')}, {client}, '}}}}')
            WHEN 'click' THEN concat({head('MESSAGE', 'ASK_TO_UNLOCK')}, {client}, {prop}, {one})
            WHEN 'purchase' THEN concat({head('BROADCAST', 'UPDATE')}, {client}, {prop}, {ids})
            ELSE CASE event_id % {len(junk)} {cases} END END)) AS text""",
    )


def _number(i: int, side: int) -> str:
    base = f"p_partkey * {i + 3} % 97"
    drift = f"CASE WHEN p_partkey % {31 + i} = 0 THEN 1 ELSE 0 END * {side}"
    return (
        f"CASE WHEN p_partkey % {41 + i + side} = 0 THEN NULL WHEN p_partkey % {43 + i + side} = 0 THEN 'NaN' "
        f"WHEN p_partkey % {47 + i} = 0 THEN '1,000' ELSE CAST({base} + {drift} AS STRING) END"
    )


def drift_columns() -> dict[str, dict[str, str]]:
    """Column expressions of the four older read models, in SQL both engines read."""
    key = {"booking_id": "CASE WHEN p_partkey % 60 <> 1 THEN CAST(p_partkey AS STRING) END"}
    text = lambda name, gap: (
        f"CASE WHEN p_partkey % {gap} = 0 THEN ' ' WHEN p_partkey % {gap + 2} = 0 THEN NULL "
        f"WHEN p_partkey % {gap + 4} = 0 THEN '{name} x' ELSE '{name}x' END"
    )
    summary = {c: text(c, 90 + i) for i, c in enumerate(["billing_status", "invoice_no", "so_ref", "ar_refs"])}
    extract = {c: text(n, 95 + i) for i, (c, n) in enumerate(
        [("billing_status", "billing_status"), ("invoice_no", "invoice_no"), ("so_ref", "so_ref"), ("doc_num", "ar_refs")]
    )}
    pricing_rows, billing_rows, tp_rows = {}, {}, {}
    for i, (a, b) in enumerate(PRICING_BILLING):
        pricing_rows[a], billing_rows[b] = _number(i, 0), _number(i, 1)
    for i, (a, b) in enumerate(PRICING_TP):
        pricing_rows[a], tp_rows[b] = _number(i + 5, 0), _number(i + 5, 1)
    return {
        "summary_extract": key | summary,
        "billing_extract": key | extract | billing_rows,
        "pricing_extract": key | pricing_rows,
        "tp_extract": key | tp_rows,
    }


def drift_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    part = given(spark, sf_dir, "part").where("p_partkey % 25 <> 3" if name != "summary_extract" else "true")
    part = part.unionByName(part.where("p_partkey % 53 = 0"))
    return part.selectExpr(*[f"{e} AS {c}" for c, e in drift_columns()[name].items()])


