"""Row locks and their first-come queues, derived from a request log.

Requests are ordered by ``at = (ts, event_id)``. A registration opens a stint of a client on a row and the
client's next clean-up ends it. The first in a row's queue holds the lock; a stint is granted once all that
entered earlier have left. Every step is an ordered scan that splits large rows and clients.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.intervals import stab_join
from tidemark.operators.scans import scan_before
from tidemark.schemas import GROUPS
from tidemark.sources.messages import payload

AT = "struct<ts:timestamp_ntz,event_id:bigint>"
INFO = ["client", "user_id", "user_name"]


def _never() -> Column:
    """Later than any request."""
    return F.struct(
        F.lit("9999-12-31 00:00:00").cast("timestamp_ntz").alias("ts"), F.lit(2**63 - 1).cast("bigint").alias("event_id")
    )


def _null(kind: str) -> Column:
    return F.lit(None).cast(kind)


def registrations(requests: DataFrame) -> DataFrame:
    """One row per registration and row asked for."""
    return requests.where("route = 'register'").select(
        "at", "session_id", *INFO, "grp", F.posexplode("ids").alias("pos", "row_id")
    )


def clean_ups(requests: DataFrame) -> DataFrame:
    """One row per clean-up and group; one without a group cleans every group."""
    groups = F.when(F.col("grp").isNull(), F.array(*[F.lit(g) for g in GROUPS])).otherwise(F.array("grp"))
    return requests.where("route = 'clean_up'").select("client", F.explode(groups).alias("grp"), "at")


def registration_intervals(entries: DataFrame, leaves: DataFrame, parts: int | None = None) -> DataFrame:
    """Stints ``(grp, row_id, client, enter, leave)``: a registration lasts until that client's next clean-up.

    Registering again during a stint changes nothing. ``entries`` may bring ``granted_at`` from before.
    """
    if "granted_at" not in entries.columns:
        entries = entries.withColumn("granted_at", _null(AT))
    asked = entries.select(
        "client", "grp", "at", F.lit(1).alias("kind"), "row_id", "user_id", "user_name", "granted_at",
        _null(AT).alias("cleaned"),
    )
    cleaned = leaves.select(
        "client", "grp", "at", F.lit(0).alias("kind"), F.lit("").alias("row_id"), _null("string").alias("user_id"),
        _null("string").alias("user_name"), _null(AT).alias("granted_at"), F.col("at").alias("cleaned"),
    )
    scanned = scan_before(
        asked.unionByName(cleaned), ["client", "grp"], ["at", "kind", "row_id"],
        {"leave": ("last", F.col("cleaned"))}, descending=True, parts=parts,
    )
    first = F.min(F.struct("at", "user_id", "user_name", "granted_at")).alias("first")
    stints = scanned.where("kind = 1").groupBy("grp", "row_id", "client", "leave").agg(first)
    return stints.select(
        "grp", "row_id", "client", "first.user_id", "first.user_name", F.col("first.at").alias("enter"), "leave",
        "first.granted_at",
    )


def lock_holds(stints: DataFrame, parts: int | None = None, sizes: DataFrame | None = None) -> DataFrame:
    """Stints with ``granted_at`` (NULL if never) and ``queue_position``, the number present at entry.

    A stint is granted at its entry or at the latest leave of those before it, whichever is later, unless it
    has left by then. A ``granted_at`` that is already known is kept. ``sizes`` is as for :func:`scan_before`.
    """
    both = F.when(F.col("leave").isNotNull(), F.array(F.lit(1), F.lit(0))).otherwise(F.array(F.lit(1)))
    entered = F.col("kind") == 1
    moments = stints.select("*", F.explode(both).alias("kind")).select(
        "grp", "row_id", F.when(entered, F.col("enter")).otherwise(F.col("leave")).alias("at"), "kind", *INFO, "leave",
        F.col("granted_at").alias("known"), F.when(entered, F.coalesce("leave", _never())).alias("_until"),
        F.when(entered, 1).otherwise(-1).cast("bigint").alias("_delta"),
    )
    scanned = scan_before(
        moments, ["grp", "row_id"], ["at", "kind", "client"],
        {"_busy": ("max", F.col("_until")), "queue_position": ("sum", F.col("_delta"))}, parts=parts, sizes=sizes,
    ).where("kind = 1")
    turn = F.greatest("at", "_busy")
    reached = F.when(turn < F.coalesce("leave", _never()), turn)
    return scanned.select(
        "grp", "row_id", *INFO, F.col("at").alias("enter"), "leave",
        F.coalesce("known", reached).alias("granted_at"), "queue_position", F.col("known").isNotNull().alias("known"),
    )


def holder_at(probes: DataFrame, holds: DataFrame, parts: int | None = None) -> DataFrame:
    """``probes`` (grp, row_id, at, …) with the ``holder`` of their row just before ``at``, or NULL.

    Holds of a row never overlap, so the newest one that started earlier is the only candidate.
    """
    rest = [c for c in probes.columns if c not in ("grp", "row_id", "at")]
    probe = F.struct(*rest)
    kind = probes.select(probe.alias("p")).schema["p"].dataType
    asked = probes.select("grp", "row_id", "at", F.lit(0).alias("kind"), probe.alias("probe"))
    start = holds.where("granted_at IS NOT NULL").select(
        "grp", "row_id", F.col("granted_at").alias("at"), F.lit(1).alias("kind"), F.lit(None).cast(kind).alias("probe"),
        F.struct(*INFO, F.col("leave").alias("until")).alias("start"),
    )
    marks = asked.withColumn("start", F.lit(None).cast(start.schema["start"].dataType)).unionByName(start)
    # Counted before the grants are known, so that counting doesn't work them out.
    sizes = probes.select("grp", "row_id").unionByName(holds.select("grp", "row_id"))
    found = scan_before(
        marks, ["grp", "row_id"], ["at", "kind"], {"holder": ("last", F.col("start"))}, parts=parts, sizes=sizes
    ).where("kind = 0")
    held = F.col("holder").isNotNull() & (F.col("at") < F.coalesce("holder.until", _never()))
    return found.select(
        "grp", "row_id", "at", "probe.*", F.when(held, F.struct(*[F.col(f"holder.{c}") for c in INFO])).alias("holder")
    )


def held_rows(requests: DataFrame, holds: DataFrame, parts: int | None = None) -> DataFrame:
    """Each row that a registration or a request to unlock names, with its holder: one scan for both."""
    asked = requests.where("route IN ('register', 'ask_to_unlock')").select(
        "at", "session_id", "route", *INFO, "grp", F.posexplode("ids").alias("pos", "row_id")
    )
    return holder_at(asked, holds, parts)


def waits(holds: DataFrame) -> DataFrame:
    """Stints that had to wait, with the moment the wait ended (NULL while it lasts)."""
    waited = F.col("granted_at").isNull() | (F.col("granted_at") != F.col("enter"))
    return holds.where(waited).select("grp", "row_id", "client", "enter", F.coalesce("granted_at", "leave").alias("end"))


def _seconds(at: str) -> Column:
    return F.unix_seconds(F.col(f"{at}.ts").cast("timestamp"))


def update_recipients(requests: DataFrame, waiting: DataFrame, texts: bool = False) -> DataFrame:
    """(at, sender, recipient, …) of update broadcasts: those waiting for a named row, except the sender.

    With ``texts`` also the ``payload``, which is the same for all recipients and so is made before they are found.

    A client's waits for a row don't overlap, so only an update that names several rows can meet a recipient more than once:
    only the pairs of such updates are shuffled again, to be told apart.
    """
    updates = requests.where("route = 'update'").select("at", "session_id", F.col("client").alias("sender"), "grp", "ids").distinct()
    made = ["payload"] if texts else []
    if texts:
        updates = update_texts(updates)
    updates = updates.select("*", F.explode(F.array_distinct("ids")).alias("row_id"), _seconds("at").alias("_at"))
    last = updates.agg(F.max("_at")).scalar()
    spans = waiting.select(
        "grp", "row_id", F.col("client").alias("recipient"), "enter", "end", _seconds("enter").alias("_start"),
        F.least(F.coalesce(_seconds("end"), last), last).alias("_end"),
    ).where("_start <= _end")
    inside = (F.col("enter") < F.col("at")) & (F.col("at") < F.coalesce("end", _never()))
    several = F.size(F.array_distinct("ids")) > 1

    def told(some: DataFrame) -> DataFrame:
        met = stab_join(some, spans, ["grp", "row_id"], "_at", "_start", "_end").where(inside & (F.col("recipient") != F.col("sender")))
        return met.select("at", "session_id", "sender", "recipient", "grp", "ids", *made)

    return told(updates.where(~several)).unionByName(told(updates.where(several)).distinct())


OUTBOX = """event_id bigint, ts timestamp_ntz, kind string, recipient string, session_id string, event string,
 status string, grp string, ids array<string>, id_info array<struct<id:string,client:string,user_id:string,user_name:string>>,
 requestor struct<client:string,user_id:string,user_name:string>, sender string"""


def _outbox(df: DataFrame, kept: tuple[str, ...] = (), **columns: Column) -> DataFrame:
    fields = [f.strip().split(" ", 1) for f in OUTBOX.replace("\n", " ").split(", ")]
    columns = {"event_id": F.col("at.event_id"), "ts": F.col("at.ts"), **columns}
    return df.select(*[columns.get(name, F.lit(None)).cast(kind.strip()).alias(name) for name, kind in fields], *kept)


def registration_replies(held: DataFrame) -> DataFrame:
    """One reply per registration: the rows someone already holds, and who."""
    asked = held.where("route = 'register'")
    info = F.struct("pos", F.col("row_id").alias("id"), "holder.client", "holder.user_id", "holder.user_name")
    locked = F.sort_array(F.collect_list(F.when(F.col("holder").isNotNull(), info)))
    # The collected list is the ids of one message.
    replies = asked.groupBy("at", "session_id", "client", "grp").agg(locked.alias("locked"))
    id_info = F.transform("locked", lambda x: x.dropFields("pos"))
    return _outbox(
        replies, kind=F.lit("REPLY"), recipient=F.col("client"), session_id=F.col("session_id"),
        event=F.lit("REGISTRATION"), grp=F.col("grp"), ids=F.col("locked.id"), id_info=id_info, sender=F.col("client"),
    )


def with_lock_id(holds: DataFrame) -> DataFrame:
    """Add ``lock_id``: the same for the same lock in every run; NULL while the client waits."""
    parts = [F.coalesce(F.col(c), F.lit("")) for c in ("grp", "row_id", "client")]
    name = F.concat_ws("|", *parts, F.col("granted_at.event_id").cast("string"))
    return holds.withColumn("lock_id", F.when(F.col("granted_at").isNotNull(), F.md5(name.cast("binary"))))


def release_notices(holds: DataFrame) -> DataFrame:
    """To each client whose wait for a row ended with the lock; caused by the clean-up that freed it."""
    promoted = holds.where("granted_at IS NOT NULL AND granted_at != enter AND NOT known")
    promoted = promoted.withColumn("at", F.col("granted_at"))
    return _outbox(
        promoted, kind=F.lit("DIRECT"), recipient=F.col("client"), session_id=F.lit(""), event=F.lit("RELEASE"),
        grp=F.col("grp"), ids=F.array("row_id"),
    )


def unlock_requests(rows: DataFrame) -> DataFrame:
    """Requests to unlock, forwarded to the row's holder, or answered FAILED when nobody holds it."""
    held = F.col("holder").isNotNull()
    return _outbox(
        rows.where("route = 'ask_to_unlock'"), kind=F.lit("DIRECT"), recipient=F.coalesce("holder.client", "client"),
        session_id=F.when(held, "").otherwise(F.col("session_id")), event=F.lit("ASK_TO_UNLOCK"),
        status=F.when(held, "REQUEST").otherwise("FAILED"), grp=F.col("grp"), ids=F.array("row_id"),
        requestor=F.when(held, F.struct(*INFO)), sender=F.col("client"),
    )


def update_notices(requests: DataFrame, holds: DataFrame, texts: bool = False) -> DataFrame:
    return update_outbox(update_recipients(requests, waits(holds), texts))


def update_texts(updates: DataFrame) -> DataFrame:
    """Add ``payload`` to updates, which is the same whoever is told."""
    rest = tuple(c for c in updates.columns if c not in ("session_id", "grp", "ids", "sender"))
    blank = _outbox(updates, rest, session_id=F.col("session_id"), event=F.lit("UPDATE"), grp=F.col("grp"), ids=F.col("ids"), sender=F.col("sender"))
    return payload(blank).select(*updates.columns, "payload")


def update_outbox(sent: DataFrame) -> DataFrame:
    """The outbox rows of update broadcasts: of ``at``, ``session_id``, ``sender``, ``recipient``, ``grp``, ``ids`` (and ``payload``)."""
    return _outbox(
        sent, kept=tuple({"payload"} & set(sent.columns)), kind=F.lit("BROADCAST"), recipient=F.col("recipient"), session_id=F.col("session_id"),
        event=F.lit("UPDATE"), grp=F.col("grp"), ids=F.col("ids"), sender=F.col("sender"),
    )


def route_messages(requests: DataFrame, holds: DataFrame, parts: int | None = None, texts: bool = False) -> DataFrame:
    """The outbox: one row per recipient of every message the requests lead to, with ``texts`` also its ``payload``."""
    held = held_rows(requests, holds, parts)
    alone = [registration_replies(held), release_notices(holds), unlock_requests(held)]
    return reduce(DataFrame.unionByName, [*(map(payload, alone) if texts else alone), update_notices(requests, holds, texts)])
