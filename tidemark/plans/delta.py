"""Detection that follows changes: a batch reads its own rows and what shares a key with them.

The four detectors of changed documents are joins, and each change of an input is joined with what the other side holds under its keys.
ARNR, BN and the three level-triggered ones are decided by booking, from all rows of that booking: bookings that a batch
touches are decided anew, and what they gave before is taken back. After any split of the tables into batches, and
whatever rows left again, the events are those of one full pass at the same moment.

State is a folder per day, as a day starts with an empty ledger and other documents: start a new one from the whole tables, as
its first batch, and drop the old.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.clock import Clock, as_clock
from tidemark.functions.text import concat_text, is_blank
from tidemark.operators.deltas import WEIGHT, Store, joined_change, net, newest_join_change, union, weighted
from tidemark.operators.filters import created_on, not_cancelled
from tidemark.operators.joins import cell_keys, csv_refs, reference_keys
from tidemark.operators.merge import with_stamp
from tidemark.operators.shuffled import shuffled
from tidemark.plans.detectors import changed_heads, detect_bn, listed, stale_ids
from tidemark.plans.fetch import LEVEL, merge_events
from tidemark.schemas import TABLES
from tidemark.session import materialize

#: Events that carry the moment of the run, not the document's.
OF_THE_RUN = (*LEVEL, "ARNR")
#: Tables that detection reads, with the columns it reads.
INPUTS: dict[str, T.StructType] = {
    name: TABLES[name]
    for name in (
        "payable_head", "payable_line", "payment_head", "payment_line", "order_head", "order_line", "receivable_head", "receivable_line",
        "item", "tp", "read_model",
    )
} | {"pricing": T.StructType().add("booking_id", "string"), "pod": T.StructType().add("booking_id", "string").add("ptf_no", "string")}

_EVENT = "serial string, stamp decimal(20,0)"
_LINE = "doc_entry bigint, item string"
STORES = {
    "ap_head": (f"doc_entry bigint, {_EVENT}", "doc_entry"),
    "ap_line": (_LINE, "doc_entry"),
    "ap_keys": (f"tag string, key string, {_EVENT}", "tag", "key"),
    "tp_keys": ("tag string, key string, id string", "tag", "key"),
    "op_head": (f"payment bigint, {_EVENT}", "payment"),
    "op_line": ("payment bigint, invoice bigint", "payment"),
    "op_paid": (f"invoice bigint, {_EVENT}", "invoice"),
    "op_invoice": ("invoice bigint, doc_num bigint", "invoice"),
    "op_docs": (f"doc_num bigint, {_EVENT}", "doc_num"),
    "op_refs": ("doc_num bigint, id string", "doc_num"),
    "so_head": (f"doc_entry bigint, {_EVENT}", "doc_entry"),
    "so_line": (_LINE, "doc_entry"),
    "so_docs": (f"doc_num bigint, {_EVENT}", "doc_num"),
    "so_refs": ("doc_num bigint, id string", "doc_num"),
    "ar_head": (f"doc_entry bigint, {_EVENT}", "doc_entry"),
    "ar_line": (_LINE, "doc_entry"),
    "live_head": ("doc_entry bigint, doc_num bigint", "doc_entry"),
    "live": ("item string, doc_num bigint", "item"),
    "item": ("item string, create_date date, create_ts int", "item"),
    "pricing": ("booking_id string", "booking_id"),
    "pod": ("booking_id string, ptf_no string", "booking_id"),
    "model": ("booking_id string, ar_refs string, ptf_no string", "booking_id"),
    "model_size": ("kind string", "kind"),
    "touched": ("id string, kind string", "id"),
    "view": ("id string, detector string, part string", "id"),
}


def as_changes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of any of the tables as one stream carries them: ``table``, ``weight``, ``row`` (JSON)."""
    return union(
        [weighted(df).select(F.lit(name).alias("table"), F.col(WEIGHT).cast("bigint").alias(WEIGHT), F.to_json(F.struct(*INPUTS[name].names)).alias("row")) for name, df in tables.items()]
    )


def split_changes(changes: DataFrame) -> dict[str, DataFrame]:
    """The tables that occur in ``changes`` (as :func:`as_changes` gives them); other names are an error."""
    changes = materialize(changes.select("table", WEIGHT, "row"))
    names = [r.table for r in changes.select("table").distinct().collect()]  # as many as there are tables
    unknown = sorted(set(names) - set(INPUTS), key=str)
    if unknown:
        raise ValueError(f"changes of unknown tables: {unknown}")
    return {n: changes.where(F.col("table") == n).select(F.from_json("row", INPUTS[n]).alias("r"), WEIGHT).select("r.*", WEIGHT) for n in names}


class DeltaDetection:
    """The events of one day, kept up to date in the folder ``root``."""

    def __init__(self, spark: SparkSession, root: str, as_of: Clock, lookback_days: int = 0, buckets: int = 32) -> None:
        self.spark, self.root, self.as_of, self.lookback_days, self.buckets = spark, root, as_of, lookback_days, buckets

    @cached_property
    def stores(self) -> dict[str, Store]:
        return {name: Store(self.spark, f"{self.root}/{name}", ddl, tuple(keys), self.buckets) for name, (ddl, *keys) in STORES.items()}

    def apply(self, changes: Mapping[str, DataFrame], batch: int) -> None:
        """Take in a batch. ``changes``: of each table that changes, its rows, with ``weight`` -1 for those that leave.

        Batches are numbered upwards; a number that is applied again replaces that batch.
        """
        got = {name: weighted(df) for name, df in changes.items()}
        unknown = sorted(set(got) - set(INPUTS))
        if unknown:
            raise ValueError(f"changes of unknown tables: {unknown}")
        store, changed = self.stores, set()

        def add(name: str, rows: DataFrame | None) -> None:
            if rows is not None:
                store[name].add(rows, batch)
                changed.add(name)

        def heads(table: str, prefix: str, mode: str | None = None) -> DataFrame | None:
            head = got.get(table)
            if head is None:
                return None
            return changed_heads(not_cancelled(head, mode) if mode else head, prefix, self.as_of, self.lookback_days)

        def lines(table: str) -> DataFrame | None:
            return got[table].where("item IS NOT NULL") if table in got else None

        def join(left: str, right: str) -> DataFrame | None:
            return joined_change(store[left], store[right], batch, left in changed, right in changed)

        def newest(events: str, rows: str) -> DataFrame | None:
            return newest_join_change(store[events], store[rows], batch, events in changed, rows in changed)

        model = got.get("read_model")
        view: list[DataFrame] = []

        def found(detector: str, rows: DataFrame | None) -> None:
            if rows is not None:
                view.append(rows.select("id", F.lit(detector).alias("detector"), F.col("serial").alias("part"), WEIGHT))

        def payables() -> None:
            """Keys of changed heads, from their cells and from their lines, against references."""
            head = heads("payable_head", "AP")
            add("ap_head", head)
            add("ap_line", lines("payable_line"))
            by_item = join("ap_head", "ap_line")
            keys = [cell_keys(head)] if head is not None else []
            if by_item is not None:
                keys.append(by_item.select("serial", "stamp", WEIGHT, F.lit("item").alias("tag"), F.col("item").alias("key")))
            add("ap_keys", union(keys))
            add("tp_keys", reference_keys(got["tp"]) if "tp" in got else None)
            found("AP", newest("ap_keys", "tp_keys"))

        def payments() -> None:
            """Live payments, by line to the invoice, by its number to the read model's lists."""
            head = heads("payment_head", "OP", "not_y")
            add("op_head", head.withColumnRenamed("doc_entry", "payment") if head is not None else None)
            paid = got.get("payment_line")
            add("op_line", paid.select(F.col("doc_num").alias("payment"), F.col("doc_entry").alias("invoice"), WEIGHT) if paid is not None else None)
            add("op_paid", join("op_head", "op_line"))
            invoices = got.get("payable_head")
            add("op_invoice", invoices.withColumnRenamed("doc_entry", "invoice") if invoices is not None else None)
            add("op_docs", join("op_paid", "op_invoice"))
            add("op_refs", csv_refs(model, ["doc_refs", "paid_refs"]) if model is not None else None)
            found("OP", newest("op_docs", "op_refs"))

        def orders() -> None:
            """By line item, and by the number that the read model holds as text."""
            head = heads("order_head", "SO")
            add("so_head", head)
            add("so_line", lines("order_line"))
            by_item = join("so_head", "so_line")
            found("SO", by_item.withColumnRenamed("item", "id") if by_item is not None else None)
            add("so_docs", head)
            refs = F.col("booking_id").alias("id"), F.col("so_ref").try_cast("bigint").alias("doc_num")
            add("so_refs", model.select(*refs, WEIGHT).where("id IS NOT NULL") if model is not None else None)
            found("SO", newest("so_docs", "so_refs"))

        def receivables() -> None:
            """By line item; and the live documents of each item."""
            add("ar_head", heads("receivable_head", "AR"))
            add("ar_line", lines("receivable_line"))
            by_item = join("ar_head", "ar_line")
            found("AR", by_item.withColumnRenamed("item", "id") if by_item is not None else None)
            head = got.get("receivable_head")
            add("live_head", not_cancelled(head, "is_n").where("doc_num IS NOT NULL") if head is not None else None)
            add("live", join("live_head", "ar_line"))

        def bookings() -> None:
            item = got.get("item")
            add("item", created_on(item.where("item IS NOT NULL"), self.as_of, self.lookback_days) if item is not None else None)
            add("pricing", got.get("pricing"))
            add("pod", got.get("pod"))
            add("model", model)
            if model is not None:
                kind = F.when(F.col("booking_id").isNull(), "null").otherwise("key").alias("kind")
                add("model_size", model.groupBy(kind).agg(F.sum(WEIGHT).alias(WEIGHT)))

        # Their stores are their own, so that they wait for nothing but each other's cores.
        chains = payables, payments, orders, receivables, bookings
        with ThreadPoolExecutor(len(chains)) as pool:
            for done in [pool.submit(inheritable_thread_target(self.spark)(chain)) for chain in chains]:
                done.result()
        view += self._decided(batch, changed)
        store["view"].add(net(union(view)) if view else self.spark.createDataFrame([], store["view"]._schema()), batch)

    def _decided(self, batch: int, changed: set[str]) -> list[DataFrame]:
        """For bookings that the batch touches: what ARNR, BN and the level-triggered detectors say now, less what they said."""
        store = self.stores
        inputs = {"ARNR": ("live", "model"), "BN": ("item", "pod", "pricing", "model"), "LEVEL": ("pod", "model")}
        kinds = {kind: [n for n in names if n in changed] for kind, names in inputs.items()}
        touched = union(
            [store[n].of(batch).select(F.col(store[n].keys[0]).alias("id"), F.lit(kind).alias("kind")).distinct() for kind, names in kinds.items() for n in names]
        )
        if touched is None:
            return []
        store["touched"].add(weighted(touched.distinct()), batch)
        buckets, ids = store["touched"].touched(batch), store["touched"].of(batch)
        detectors = {"ARNR": ("ARNR",), "BN": ("BN",), "LEVEL": LEVEL}

        def live(name: str, kind: str, n: int = batch) -> DataFrame:
            """The rows of the bookings touched, with their number."""
            keys = ids.where(F.col("kind") == kind).select(F.col("id").alias(store[name].keys[0]))
            return net(store[name].at(n, keys, buckets).drop("batch")).where(F.col(WEIGHT) > 0)

        # Written out: what follows is by booking too, and a task would hold the sorts and groups of every input at once.
        wanted = [(kind, name) for kind, names in inputs.items() if kinds[kind] for name in names]
        with ThreadPoolExecutor(len(wanted)) as pool:
            written = [pool.submit(inheritable_thread_target(self.spark)(lambda kind, name: materialize(live(name, kind))), *one) for one in wanted]
            rows = dict(zip(wanted, [w.result() for w in written]))

        out = []
        if kinds["ARNR"]:
            counts = rows["ARNR", "live"].withColumnRenamed(WEIGHT, "n_lines")
            stale = listed(materialize(stale_ids(rows["ARNR", "model"].select("booking_id", "ar_refs").distinct(), counts)), counts)
            out.append(("ARNR", stale.select(F.col("booking_id").alias("id"), concat_text("AR", F.col("listed"), "-NR-").alias("part"))))
        if kinds["BN"]:
            names = {"item": "item", "pod": "pod", "pricing": "pricing", "read_model": "model"}
            fresh = detect_bn({table: rows["BN", n] for table, n in names.items()}, self.as_of, self.lookback_days)
            out.append(("BN", fresh.select("id", F.col("serial").alias("part"))))
        if kinds["LEVEL"]:
            model = rows["LEVEL", "model"].groupBy("booking_id").agg(F.sum(WEIGHT).alias("n_rows"), F.max(is_blank(F.col("ptf_no"))).alias("blank_ptf"))
            pod = rows["LEVEL", "pod"].groupBy("booking_id").agg(F.max(~is_blank(F.col("ptf_no"))).alias("has_ptf"))
            both = model.join(shuffled(pod), "booking_id", "full").withColumnRenamed("booking_id", "id")
            tests = {"DUP": F.col("n_rows") > 1, "PTF": F.col("has_ptf") & F.col("blank_ptf"), "MISSING": F.col("n_rows").isNull()}
            out += [(name, both.where(test).select("id", F.lit(f"{name}-").alias("part"))) for name, test in tests.items()]
        now = [df.select("id", F.lit(name).alias("detector"), "part", F.lit(1).cast("bigint").alias(WEIGHT)) for name, df in out]
        before = [
            live("view", kind, batch - 1).where(F.col("detector").isin(*detectors[kind])).withColumn(WEIGHT, F.lit(-1).cast("bigint")) for kind in kinds if kinds[kind]
        ]
        return now + before

    def events(self, as_of: Clock | None = None) -> DataFrame:
        """(id, serial, detector, stamp) as of the last batch; ``as_of`` is the moment of the run, if it is another one.

        Of documents' events under one key only the newest are kept, which is what one event per id needs.
        """
        now = as_clock(as_of or self.as_of).stamp()
        live = net(self.stores["view"].until()).where(F.col(WEIGHT) > 0)
        nulls = self.stores["model_size"].until().where("kind = 'null'").agg(F.coalesce(F.sum(WEIGHT), F.lit(0))).scalar()
        heard = live.where((F.col("detector") != "MISSING") | (nulls == 0))
        serial = F.when(F.col("detector").isin(*OF_THE_RUN), concat_text(F.col("part"), now)).otherwise(F.col("part"))
        return with_stamp(heard.select("id", serial.alias("serial"), "detector"))

    def fetch(self, ledger: DataFrame | None = None, limit: int | None = None, position: bool = False, as_of: Clock | None = None) -> DataFrame:
        """One event per id that the ledger lacks, as ``fetch_events`` gives them."""
        return merge_events(self.events(as_of), ledger, limit=limit, position=position)
