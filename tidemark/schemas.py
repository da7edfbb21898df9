"""Explicit schemas of the input tables; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


_S, _L, _I, _D, _DATE, _TS = (
    T.StringType(),
    T.LongType(),
    T.IntegerType(),
    T.DoubleType(),
    T.DateType(),
    T.TimestampNTZType(),
)

_HEAD = dict(doc_entry=_L, doc_num=_L, create_date=_DATE, update_date=_DATE, update_ts=_I, cancelled=_S)
_LINE = dict(doc_entry=_L, item=_S)
_SIDE = dict(booking_id=_S, code=_S)

EVENT = T.StructType([T.StructField("id", _S, False), T.StructField("serial", _S, False)])
EVENT_FILE = T.StructType([*EVENT.fields, T.StructField("bad_text", _S)])
LEDGER = _table(id=_S, serial=_S, processed_at=T.TimestampType(), day=_DATE)

TABLES: dict[str, T.StructType] = {
    "payable_head": _table(**_HEAD, pv_no=_S),
    "payable_line": _table(**_LINE),
    "payment_head": _table(**_HEAD),
    "payment_line": _table(doc_num=_L, doc_entry=_L),
    "order_head": _table(**_HEAD),
    "order_line": _table(**_LINE),
    "receivable_head": _table(**_HEAD),
    "receivable_line": _table(**_LINE),
    "item": _table(item=_S, create_date=_DATE, create_ts=_I),
    "partner": _table(code=_S, name=_S, cdc=_I, dcd=_I, group_location=_S, vat_status=_S),
    "billing": _table(**_SIDE, so_ref=_S),
    "tp": _table(**_SIDE, pv_no=_S),
    "pricing": _table(
        **_SIDE,
        gross_rates=_D,
        demurrage2=_D,
        addtl_drop=_D,
        boom_truck=_D,
        manpower=_D,
        backload=_D,
    ),
    "read_model": _table(booking_id=_S, so_ref=_S, doc_refs=_S, paid_refs=_S, ar_refs=_S, ptf_no=_S),
    "rates_staging": _table(booking_id=_S, amount=_S, addl_amount=_S),
}

# The closed sets a client message may use.
MESSAGE_TYPES = ["MESSAGE", "BROADCAST"]
MESSAGE_EVENTS = ["REGISTRATION", "CONNECTION_ESTABLISHED", "CLEAN_UP", "RELEASE", "UPDATE", "ASK_TO_UNLOCK"]
MESSAGE_STATUSES = ["REQUEST", "FAILED"]
GROUPS = ["pod", "billing", "tp", "pricing"]

_CLIENT = _table(clientId=_S, userId=_S, userName=_S)
_PROP = T.StructType(
    [
        T.StructField("group", _S),
        T.StructField("id", _S),
        T.StructField("ids", T.ArrayType(_S)),
        T.StructField("idInfo", T.ArrayType(_table(id=_S, userInfo=_CLIENT))),
    ]
)
MESSAGE = T.StructType(
    [
        T.StructField("sessionId", _S),
        T.StructField("type", _S),
        T.StructField("event", _S),
        T.StructField(
            "data",
            T.StructType(
                [
                    T.StructField("clientId", _S),
                    T.StructField("userId", _S),
                    T.StructField("userName", _S),
                    T.StructField("status", _S),
                    T.StructField("prop", _PROP),
                    T.StructField("requestorInfo", _CLIENT),
                ]
            ),
        ),
    ]
)
MESSAGE_LOG = T.StructType(
    [T.StructField("event_id", _L), T.StructField("ts", _TS), T.StructField("text", _S)]
)
