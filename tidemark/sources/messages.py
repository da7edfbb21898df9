"""The client message log: JSON texts in, routed requests out, outbox payloads back to JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.schemas import GROUPS, MESSAGE

# Which (type, event) each kind of request arrives as; other combinations ask for nothing.
ROUTES = {
    "register": ("MESSAGE", "REGISTRATION"),
    "clean_up": ("MESSAGE", "CLEAN_UP"),
    "ask_to_unlock": ("MESSAGE", "ASK_TO_UNLOCK"),
    "update": ("BROADCAST", "UPDATE"),
}


def once(value: Column) -> Column:
    """``value`` as a generator's only row.

    Filters and projections above a generator keep referring to its output, so an expensive value is computed
    once per row instead of once per mention.
    """
    return F.explode(F.array(value))


def mark_containers(log: DataFrame) -> DataFrame:
    """``log`` with ``_ok``: whether the text is one non-empty JSON object or array. Each text is parsed once for it."""
    # Inside brackets, a valid value that is followed by something else is no longer valid or no longer alone.
    wrapped = F.try_parse_json(F.concat(F.lit("["), "text", F.lit("]")))
    alone = F.col("_v").isNotNull() & F.try_variant_get("_v", "$[1]", "variant").isNull()
    container = F.col("text").rlike(r"^\s*[{\[]") & ~F.col("text").rlike(r"^\s*(\{\s*\}|\[\s*\])\s*$")
    ok = F.coalesce(container & alone, F.lit(False))
    return log.select("*", once(wrapped).alias("_v")).select(*log.columns, once(ok).alias("_ok"))


def parse_messages(log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected): messages with their fields, and texts that are no non-empty object or array."""
    marked = mark_containers(log)
    rest = [c for c in log.columns if c != "text"]
    parsed = marked.where("_ok").select(*rest, once(F.from_json("text", MESSAGE)).alias("m"))
    fields = ["sessionId", "type", "event", "data"]
    valid = parsed.select(*rest, *[F.col(f"m.{f}").alias(f) for f in fields])
    return valid, marked.where("NOT _ok").drop("_ok")


def _route() -> Column:
    route = F.lit(None).cast("string")
    for name, (kind, event) in ROUTES.items():
        route = F.when((F.col("type") == kind) & (F.col("event") == event), name).otherwise(route)
    return route


def dispatch(messages: DataFrame) -> DataFrame:
    """Messages that ask for something, with the ``route`` they take."""
    return messages.withColumn("route", _route()).where("route IS NOT NULL")


def _flat(dispatched: DataFrame, *more: str) -> DataFrame:
    """Flat rows of dispatched messages, and whether each is ``_usable``."""
    ids = F.array_distinct(F.when(F.col("route") == "ask_to_unlock", F.array("data.prop.id")).otherwise(F.col("data.prop.ids")))
    flat = dispatched.select(
        F.struct("ts", "event_id").alias("at"),
        F.coalesce(F.col("sessionId"), F.lit("")).alias("session_id"),
        "route",
        F.col("data.clientId").alias("client"),
        F.col("data.userId").alias("user_id"),
        F.col("data.userName").alias("user_name"),
        F.col("data.prop.group").alias("grp"),
        once(ids).alias("ids"),
        *more,
    )
    grouped = F.col("grp").isin(GROUPS)
    named = grouped & F.col("ids").isNotNull() & ~F.exists("ids", lambda i: i.isNull())
    usable = F.col("client").isNotNull() & F.when(
        F.col("route") == "clean_up", F.col("grp").isNull() | grouped
    ).otherwise(named)
    return flat.withColumn("_usable", F.coalesce(usable, F.lit(False)))


def to_requests(dispatched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(requests, invalid): flat rows of the dispatched messages; a request needs a client and known fields.

    A clean-up without a group concerns all groups; every other request needs one of the known groups and ids.
    """
    flat = _flat(dispatched)
    return flat.where("_usable").drop("_usable"), flat.where("NOT _usable").drop("_usable")


def sort_requests(log: DataFrame) -> DataFrame:
    """What the usable, the invalid and the malformed messages of a log are, in one pass: requests with the ``reason`` they are no use for, or NULL."""
    rest = [c for c in log.columns if c != "text"]
    message = once(F.when(F.col("_ok"), F.from_json("text", MESSAGE))).alias("m")
    parsed = mark_containers(log).select(*rest, "_ok", message).select(*rest, "_ok", *[f"m.{f}" for f in ("sessionId", "type", "event", "data")])
    routed = parsed.select("*", once(_route()).alias("route")).where("NOT _ok OR route IS NOT NULL")
    reason = F.when(~F.col("_ok"), "malformed").when(~F.col("_usable"), "invalid")
    return _flat(routed, "_ok").withColumn("reason", reason).drop("_ok", "_usable")


def payload(outbox: DataFrame) -> DataFrame:
    """Add ``payload``: the JSON text sent to the recipient."""
    info = F.transform(
        "id_info",
        lambda i: F.struct(
            i["id"].alias("id"),
            F.struct(
                i["client"].alias("clientId"), i["user_id"].alias("userId"), i["user_name"].alias("userName")
            ).alias("userInfo"),
        ),
    )
    single = F.col("event").isin("RELEASE", "ASK_TO_UNLOCK")
    prop = F.struct(
        F.col("grp").alias("group"),
        F.when(single, F.element_at("ids", 1)).alias("id"),
        F.when(~single, F.col("ids")).alias("ids"),
        info.alias("idInfo"),
    )
    requestor = F.when(
        F.col("requestor").isNotNull(),
        F.struct(
            F.col("requestor.client").alias("clientId"),
            F.col("requestor.user_id").alias("userId"),
            F.col("requestor.user_name").alias("userName"),
        ),
    )
    sender = F.when(F.col("event") == "UPDATE", F.col("sender"))
    data = F.struct(
        sender.alias("clientId"), F.col("status"), prop.alias("prop"), requestor.alias("requestorInfo")
    )
    message = F.struct(
        F.col("session_id").alias("sessionId"), F.lit("MESSAGE").alias("type"), F.col("event"), data.alias("data")
    )
    return outbox.withColumn("payload", F.to_json(message))
