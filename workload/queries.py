"""One query per operator, over the role views of the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions import metrics as M, text as X
from tidemark.functions.clock import Clock, day_text
from tidemark.functions.serial import last_segment, legacy_stamp, serial_stamp
from tidemark.functions.sql import register_functions
from tidemark.operators import aggregates as A, filters as FL, joins as J, locks as L, merge as MG
from tidemark.operators.shuffled import shuffled
from tidemark.operators.snapshots import pending_snapshots
from tidemark.plans import booking_view as V, delta as DL, detectors as D, drift as R, fetch as P, refresh as RF
from tidemark.plans.lock_history import lock_history, read_requests
from tidemark.session import materialize, shared_dir
from tidemark.sources.bucketed_model import BucketedModel
from tidemark.sources.event_stream import register_event_files
from tidemark.sources.events import read_event_file, usable
from tidemark.sources.ledger import append_ledger, ledger_for
from tidemark.sources.messages import dispatch, parse_messages, payload, to_requests
from tidemark.sources.read_model import ReadModel, upsert_rows
from tidemark.sources.tables import TableConfig, read_table
from tidemark.streaming import polling
from tidemark.streaming.keyed_locks import KeyedLocks
from tidemark.streaming.lock_stream import LockStream
from tidemark.streaming.polling import refresh_on_arrival, run_incremental
from workload import roles
from workload.roles import AS_OF, LOOKBACK, drift_table, given, tables, whole_tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder of this run in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def day(name: str):
    return F.date_format(name, "yyyy-MM-dd").alias(name)


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_requests(roles.message_log(spark, sf_dir))


def holds(spark: SparkSession, sf_dir: str, asked: DataFrame | None = None) -> DataFrame:
    return lock_history(asked if asked is not None else requests(spark, sf_dir))


def at_id(name: str, alias: str):
    return F.col(f"{name}.event_id").alias(alias)


# --- sources --------------------------------------------------------------------------------------------


@query
def read_table_source(spark, sf_dir):
    cfg = TableConfig(root=sf_dir, names={"orders": "orders.parquet"})
    return read_table(spark, "orders", cfg).select("o_orderkey", "o_custkey", "o_orderstatus")


@query
def event_file(spark, sf_dir):
    path = scratch(spark, "events")
    D.detect_ar(whole_tables(spark, sf_dir), AS_OF, LOOKBACK).write.json(path)
    return read_event_file(spark, path, multi_line=False)


@query
def event_file_array(spark, sf_dir):
    """The same events as files of one JSON array each."""
    path = scratch(spark, "events")
    events = D.detect_ar(tables(spark, sf_dir), AS_OF, LOOKBACK).select(F.to_json(F.struct("id", "serial")).alias("one"))
    arrays = events.groupBy(F.pmod(F.xxhash64("one"), F.lit(16))).agg(F.array_join(F.collect_list("one"), ",").alias("all"))
    arrays.select(F.concat(F.lit("["), "all", F.lit("]"))).write.option("maxRecordsPerFile", 1).text(path)
    return read_event_file(spark, path)


@query
def event_file_stream(spark, sf_dir):
    """The same events as files that land in two folders; the second run of the stream goes on where the first ended."""
    root, name = scratch(spark, "events"), register_event_files(spark)
    events = D.detect_ar(tables(spark, sf_dir), AS_OF, LOOKBACK)
    for part in (0, 1):
        events.where(F.pmod(F.xxhash64("id"), F.lit(2)) == part).write.json(f"{root}/in/part={part}")
        rows = spark.readStream.format(name).option("path", f"{root}/in").load().where(usable()).select("id", "serial")
        writer = rows.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint")
        writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{root}/out")


@query
def incremental_poll(spark, sf_dir):
    root = scratch(spark, "poll")
    source = spark.readStream.schema(roles.GIVEN["events"]).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    keep = lambda batch, n: batch.select("event_id", "event_type").write.mode("overwrite").parquet(f"{root}/data/batch={n}")
    run_incremental(source, keep, f"{root}/checkpoint", "available_now").awaitTermination()
    return spark.read.parquet(f"{root}/data").select("event_id", "event_type")


@query
def messages_valid(spark, sf_dir):
    valid, _ = parse_messages(roles.message_log(spark, sf_dir))
    return valid.select(
        "event_id",
        F.col("sessionId").alias("session_id"),
        "type",
        "event",
        F.col("data.clientId").alias("client"),
        F.col("data.prop.group").alias("grp"),
    )


@query
def messages_rejected(spark, sf_dir):
    return parse_messages(roles.message_log(spark, sf_dir))[1].select("event_id", "text")


@query
def message_dispatch(spark, sf_dir):
    valid, _ = parse_messages(roles.message_log(spark, sf_dir))
    return dispatch(valid).select("event_id", "route")


@query
def message_requests(spark, sf_dir):
    return requests(spark, sf_dir).select(
        at_id("at", "event_id"), "route", "client", "grp", F.array_join("ids", ",").alias("ids")
    )


# --- filters --------------------------------------------------------------------------------------------


@query
def changed_on(spark, sf_dir):
    return FL.changed_on(roles.heads(spark, sf_dir), AS_OF, LOOKBACK).select(
        "doc_num", day("create_date"), day("update_date")
    )


@query
def created_on(spark, sf_dir):
    return FL.created_on(roles.heads(spark, sf_dir), AS_OF).select("doc_num", day("create_date"))


@query
def blank_filter(spark, sf_dir):
    return roles.read_model(spark, sf_dir).where(X.is_blank(F.col("ptf_no"))).select("booking_id", "ptf_no")


@query
def not_null_keys(spark, sf_dir):
    return roles.items(spark, sf_dir).where(F.col("item").isNotNull()).select("item", day("create_date"))


@query
def not_cancelled_is_n(spark, sf_dir):
    return FL.not_cancelled(roles.payment_head(spark, sf_dir), "is_n").select("doc_num")


@query
def not_cancelled_not_y(spark, sf_dir):
    return FL.not_cancelled(roles.payment_head(spark, sf_dir), "not_y").select("doc_num")


@query
def csv_membership(spark, sf_dir):
    first = F.concat(F.lit("PV"), (F.col("booking_id").cast("bigint") * 7 + 3).cast("string"))
    return roles.tp(spark, sf_dir).where(X.csv_contains(F.col("pv_no"), first)).select("booking_id", "pv_no")


@query
def disjunctive_existence(spark, sf_dir):
    t = tables(spark, sf_dir)
    return J.in_any(t["item"], "item", (t["billing"], "booking_id"), (t["pricing"], "booking_id")).select("item")


@query
def text_has(spark, sf_dir):
    return roles.pod(spark, sf_dir).where(X.text_has(F.col("status_detail"), *R.BILLABLE)).select("booking_id")


@query
def locks_kept(spark, sf_dir):
    kept, _ = FL.split_locks(holds(spark, sf_dir).where("granted_at IS NOT NULL"), "8", "pod")
    return kept.select("grp", "row_id", "client", at_id("enter", "enter_id"))


@query
def locks_removed(spark, sf_dir):
    _, removed = FL.split_locks(holds(spark, sf_dir).where("granted_at IS NOT NULL"), "8")
    return removed.select("grp", "row_id", "client", at_id("enter", "enter_id"))


# --- joins ----------------------------------------------------------------------------------------------


@query
def header_lines(spark, sf_dir):
    return J.header_lines(roles.heads(spark, sf_dir), roles.lines(spark, sf_dir)).select("doc_num", "item")


@query
def multivalue_join(spark, sf_dir):
    head = roles.heads(spark, sf_dir).withColumn("serial", F.col("doc_num").cast("string"))
    return J.multivalue_join(head, roles.lines(spark, sf_dir), roles.tp(spark, sf_dir))


@query
def csv_ref_join(spark, sf_dir):
    docs = roles.heads(spark, sf_dir).select("doc_num", F.col("doc_num").cast("string").alias("serial"))
    return J.csv_ref_join(roles.read_model(spark, sf_dir), docs, ["doc_refs", "paid_refs"])


@query
def payment_to_invoice(spark, sf_dir):
    paid = J.payment_to_invoice(
        roles.payment_head(spark, sf_dir), roles.payment_line(spark, sf_dir), roles.heads(spark, sf_dir)
    )
    return paid.select("pay_num", "doc_num")


@query
def docnum_ref_join(spark, sf_dir):
    head = roles.heads(spark, sf_dir).select("doc_num", F.col("doc_num").cast("string").alias("serial"))
    return J.docnum_ref_join(head, roles.read_model(spark, sf_dir))


@query
def semi_join_in(spark, sf_dir):
    model = roles.read_model(spark, sf_dir).where(X.is_blank(F.col("ptf_no")))
    return roles.pod(spark, sf_dir).join(model.select("booking_id"), "booking_id", "left_semi").select("booking_id")


@query
def semi_join_exists(spark, sf_dir):
    live = J.header_lines(FL.not_cancelled(roles.heads(spark, sf_dir)), roles.lines(spark, sf_dir))
    keys = live.select(F.col("item").alias("booking_id"))
    return roles.pod(spark, sf_dir).join(keys, "booking_id", "left_semi").select("booking_id")


@query
def anti_join_not_exists(spark, sf_dir):
    return J.not_exists(roles.items(spark, sf_dir), "item", roles.read_model(spark, sf_dir), "booking_id").select(
        "item", day("create_date")
    )


@query
def not_in_keys(spark, sf_dir):
    t = tables(spark, sf_dir)
    return J.not_in(t["pod"].select("booking_id"), "booking_id", t["read_model"], "booking_id")


@query
def not_in_null_keys(spark, sf_dir):
    t = tables(spark, sf_dir)
    return J.not_in(t["pod"].select("booking_id"), "booking_id", t["item"], "item")


@query
def enrich_booking(spark, sf_dir):
    t = tables(spark, sf_dir)
    star = J.enrich_booking(t["pod"], t["billing"], t["tp"], t["pricing"], t["partner"])
    return star.select("booking_id", "billing_code", "tp_code", "pricing_code", "client_name", "carrier_name")


@query
def row_disabled_flag(spark, sf_dir):
    return _disabled(spark, sf_dir, "substring")


@query
def row_disabled_flag_token(spark, sf_dir):
    return _disabled(spark, sf_dir, "token")


def _disabled(spark, sf_dir, match):
    t = tables(spark, sf_dir)
    rows = t["tp"].select("booking_id", F.col("pv_no").alias("tp_pv_no"))
    return V.row_disabled_flag(rows, t, match).select("booking_id", "disable_row")


@query
def contains_join(spark, sf_dir):
    return J.contains_join(roles.tp(spark, sf_dir), "pv_no", roles.heads(spark, sf_dir), "pv_no")


@query
def token_hits(spark, sf_dir):
    return J.token_hits(roles.tp(spark, sf_dir), "pv_no", roles.heads(spark, sf_dir), "pv_no")


@query
def valid_ref_or_blank(spark, sf_dir):
    live = FL.not_cancelled(roles.heads(spark, sf_dir))
    return J.valid_ref_or_blank(roles.billing(spark, sf_dir), "so_ref", live).select("booking_id", "so_ref")


@query
def exclude_processed(spark, sf_dir):
    events = D.detect_ar(whole_tables(spark, sf_dir), AS_OF, LOOKBACK)
    return MG.exclude_processed(events, roles.ledger(spark, sf_dir))


@query
def registration_intervals(spark, sf_dir):
    asked = requests(spark, sf_dir)
    stints = L.registration_intervals(L.registrations(asked), L.clean_ups(asked))
    return stints.select("grp", "row_id", "client", at_id("enter", "enter_id"), at_id("leave", "leave_id"))


@query
def holder_at(spark, sf_dir):
    asked = requests(spark, sf_dir)
    found = L.holder_at(L.registrations(asked), holds(spark, sf_dir, asked))
    return found.select("grp", "row_id", at_id("at", "event_id"), F.col("holder.client").alias("holder"))


# --- aggregates and order -------------------------------------------------------------------------------


@query
def duplicate_keys(spark, sf_dir):
    return A.duplicate_keys(roles.items(spark, sf_dir), "item")


def _live(spark, sf_dir):
    return D.live_doc_counts(roles.heads(spark, sf_dir), roles.lines(spark, sf_dir))


@query
def docs_per_item(spark, sf_dir):
    return A.docs_per_item(_live(spark, sf_dir))


@query
def docs_per_item_distinct(spark, sf_dir):
    return A.docs_per_item(_live(spark, sf_dir), distinct=True)


@query
def doc_list(spark, sf_dir):
    return A.doc_list(_live(spark, sf_dir))


@query
def doc_list_distinct(spark, sf_dir):
    return A.doc_list(_live(spark, sf_dir), distinct=True)


@query
def csv_size(spark, sf_dir):
    return roles.tp(spark, sf_dir).select("booking_id", X.csv_size(F.col("pv_no")).alias("n_tokens"))


@query
def select_distinct(spark, sf_dir):
    return roles.read_model(spark, sf_dir).select("booking_id", "so_ref").distinct()


@query
def run_metrics(spark, sf_dir):
    return P.counted_fetch(tables(spark, sf_dir), AS_OF, roles.ledger(spark, sf_dir), lookback_days=LOOKBACK)[1]


@query
def latest_per_id(spark, sf_dir):
    events = MG.with_stamp(D.detect_so(whole_tables(spark, sf_dir), AS_OF, LOOKBACK))
    return MG.latest_per_id(events).select("id", "serial")


@query
def first_per_id(spark, sf_dir):
    events = given(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("id"), F.col("event_type").alias("serial"), "event_id"
    )
    return MG.first_per_id(events, "event_id")


@query
def union_distinct_paths(spark, sf_dir):
    t = whole_tables(spark, sf_dir)
    head = D.changed_heads(t["order_head"], "SO", AS_OF, LOOKBACK)
    by_item = J.header_lines(head, t["order_line"]).select(F.col("item").alias("id"))
    by_number = J.docnum_ref_join(head, t["read_model"]).select("id")
    return by_item.union(by_number).distinct()


@query
def union_detectors(spark, sf_dir):
    t = tables(spark, sf_dir)
    names = ("SO", "AR", "BN", "DUP")
    events = MG.union_detectors({n: D.DETECTORS[n](t, AS_OF, lookback_days=LOOKBACK) for n in names})
    return events.withColumn("stamp", F.col("stamp").cast("bigint"))


@query
def order_by_stamp(spark, sf_dir):
    events = MG.union_detectors({"AR": D.detect_ar(whole_tables(spark, sf_dir), AS_OF, LOOKBACK)})
    return MG.order_by_stamp(events).select("id", "serial", F.col("stamp").cast("bigint").alias("stamp"))


@query
def limit_events(spark, sf_dir):
    events = MG.union_detectors({"AR": D.detect_ar(tables(spark, sf_dir), AS_OF, LOOKBACK)})
    return MG.limit_events(events, 100).select("id", "serial")


@query
def pending_steps(spark, sf_dir):
    events = MG.union_detectors({"AR": D.detect_ar(whole_tables(spark, sf_dir), AS_OF, LOOKBACK)})
    shown = pending_snapshots(events, top_n=3)
    return shown.withColumn("pending_ids", F.array_join("pending_ids", ","))


# --- detectors ------------------------------------------------------------------------------------------


def _detector(name: str, of=tables, **options) -> Query:
    return lambda spark, sf_dir: D.DETECTORS[name](of(spark, sf_dir), AS_OF, lookback_days=LOOKBACK, **options)


for _name in D.DETECTORS:
    QUERIES[f"detect_{_name.lower()}"] = _detector(_name)
QUERIES["detect_so"] = _detector("SO", whole_tables)
QUERIES["detect_arnr_legacy"] = _detector("ARNR", legacy=True)
QUERIES["detect_arnr_distinct"] = _detector("ARNR", count_distinct=True)


@query
def detect_levels(spark, sf_dir):
    return D.detect_levels(tables(spark, sf_dir), AS_OF)


@query
def detect_sbdi(spark, sf_dir):
    return R.detect_sbdi(
        drift_table(spark, sf_dir, "summary_extract"), drift_table(spark, sf_dir, "billing_extract"), AS_OF
    )


@query
def detect_bpdi(spark, sf_dir):
    return R.detect_bpdi(
        drift_table(spark, sf_dir, "pricing_extract"), drift_table(spark, sf_dir, "billing_extract"), AS_OF
    )


@query
def detect_tpdi(spark, sf_dir):
    return R.detect_tpdi(
        drift_table(spark, sf_dir, "pricing_extract"), drift_table(spark, sf_dir, "tp_extract"), AS_OF
    )


@query
def detect_bvnr(spark, sf_dir):
    extract = drift_table(spark, sf_dir, "billing_extract")
    return R.detect_bvnr(roles.pod(spark, sf_dir), roles.billing(spark, sf_dir), extract, AS_OF)


@query
def detect_bvnr_clean_keys(spark, sf_dir):
    extract = drift_table(spark, sf_dir, "billing_extract").where("booking_id IS NOT NULL")
    return R.detect_bvnr(roles.pod(spark, sf_dir), roles.billing(spark, sf_dir), extract, AS_OF)


@query
def detect_tvnr(spark, sf_dir):
    extract = drift_table(spark, sf_dir, "tp_extract")
    return R.detect_tvnr(roles.pod(spark, sf_dir), roles.tp(spark, sf_dir), extract, AS_OF)


# --- pipelines ------------------------------------------------------------------------------------------


def _fetched(events: DataFrame) -> DataFrame:
    return events.withColumn("stamp", F.col("stamp").cast("bigint"))


@query
def fetch_events(spark, sf_dir):
    return _fetched(P.fetch_events(tables(spark, sf_dir), AS_OF, lookback_days=LOOKBACK))


@query
def fetch_dedupe_then_exclude(spark, sf_dir):
    return _fetched(
        P.fetch_events(tables(spark, sf_dir), AS_OF, roles.ledger(spark, sf_dir), lookback_days=LOOKBACK)
    )


@query
def fetch_exclude_then_dedupe(spark, sf_dir):
    found = P.fetch_events(
        tables(spark, sf_dir), AS_OF, roles.ledger(spark, sf_dir), "exclude_then_dedupe", lookback_days=LOOKBACK
    )
    return _fetched(found)


@query
def fetch_limited(spark, sf_dir):
    return _fetched(P.fetch_events(tables(spark, sf_dir), AS_OF, limit=100, lookback_days=LOOKBACK))


def _view_out(view: DataFrame) -> DataFrame:
    dates = {f.name for f in view.schema if isinstance(f.dataType, T.DateType)}
    return view.select(*[day(c) if c in dates else F.col(c) for c in view.columns])


@query
def booking_view(spark, sf_dir):
    return _view_out(V.build_booking_view(tables(spark, sf_dir), AS_OF))


MODEL = ["booking_id", "so_ref", "doc_refs", "paid_refs", "ar_refs", "ptf_no"]


def _stored(spark, sf_dir, rows: DataFrame) -> ReadModel:
    model = ReadModel(spark, scratch(spark, "model"), "booking_id", rows.schema)
    model.create(rows)
    return model


def _rebuild(spark, sf_dir):
    """A row builder for the small read model: references from the billing and booking tables."""
    t = tables(spark, sf_dir)
    base = t["pod"].select("booking_id", "ptf_no")
    so = t["billing"].select("booking_id", "so_ref").distinct()
    none = [F.lit(None).cast("string").alias(c) for c in ("doc_refs", "paid_refs", "ar_refs")]
    rows = base.join(shuffled(so), "booking_id", "left").select("booking_id", "so_ref", *none, "ptf_no")
    return lambda ids: rows.join(shuffled(ids), "booking_id", "left_semi").select(*MODEL)


@query
def refresh_read_model(spark, sf_dir):
    model = _stored(spark, sf_dir, roles.read_model(spark, sf_dir).select(*MODEL))
    ids = D.detect_missing(tables(spark, sf_dir), AS_OF).union(D.detect_dup(tables(spark, sf_dir), AS_OF))
    RF.refresh_read_model(ids.select(F.col("id").alias("booking_id")), model, _rebuild(spark, sf_dir))
    return model.read()


def _bucketed(spark, rows: DataFrame) -> BucketedModel:
    base = f"model_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {base} LOCATION '{scratch(spark, 'bucketed')}'")
    model = BucketedModel(spark, f"{base}.rows", "booking_id", rows.schema, buckets=16)
    model.create(rows)
    return model


@query
def refresh_bucketed(spark, sf_dir):
    """The same refresh of a model that is bucketed by its key."""
    model = _bucketed(spark, roles.read_model(spark, sf_dir).select(*MODEL))
    ids = D.detect_missing(tables(spark, sf_dir), AS_OF).union(D.detect_dup(tables(spark, sf_dir), AS_OF))
    RF.refresh_read_model(ids.select(F.col("id").alias("booking_id")), model, _rebuild(spark, sf_dir))
    return model.read()


@query
def levels_bucketed(spark, sf_dir):
    """The level detectors on a bucketed model, which they don't shuffle."""
    model = _bucketed(spark, roles.read_model(spark, sf_dir).select(*MODEL))
    return D.detect_levels(tables(spark, sf_dir).replaced(read_model=model.read), AS_OF)


@query
def upsert_by_key(spark, sf_dir):
    target = roles.read_model(spark, sf_dir).select(*MODEL)
    ids = roles.pod(spark, sf_dir).where(F.col("ptf_no").isNull()).select("booking_id")
    return upsert_rows(target, _rebuild(spark, sf_dir)(ids), ids, "booking_id")


@query
def refresh_converges(spark, sf_dir):
    """Fetch, process, fetch: what is left are ids that failed, here bookings ending in 5.

    The second run takes up what the new references of the first one's rows lead to.
    """
    model = _stored(spark, sf_dir, roles.read_model(spark, sf_dir).select(*MODEL))
    t, root = tables(spark, sf_dir).replaced(read_model=model.read), scratch(spark, "converge")
    refresh = lambda ids: RF.refresh_read_model(ids, model, RF.model_rows(t), whole=~F.col("booking_id").endswith("5"))
    for _ in range(2):
        events = materialize(MG.drop_null_ids(P.raw_events(t, AS_OF, LOOKBACK)))
        RF.process_events(MG.with_position(events), refresh, root, AS_OF, record_all=True)
    left = P.fetch_events(t, AS_OF, ledger_for(spark, root, AS_OF), lookback_days=LOOKBACK)
    return left.select("id", "serial")


@query
def model_rows(spark, sf_dir):
    t = tables(spark, sf_dir)
    return RF.model_rows(t)(t["pod"].select("booking_id"))


@query
def refresh_with_scrub(spark, sf_dir):
    t = tables(spark, sf_dir)
    model = _stored(spark, sf_dir, roles.read_model(spark, sf_dir).select(*MODEL))
    staging = _stored(spark, sf_dir, roles.rates_staging(spark, sf_dir))
    RF.refresh_read_model(t["pod"].where("status_detail = 'Verified'").select("booking_id"), model, RF.model_rows(t), staging)
    return staging.read()


@query
def process_partial_failure(spark, sf_dir):
    """Of bookings ending in 3, building one raises; all others are refreshed."""
    model = _stored(spark, sf_dir, roles.read_model(spark, sf_dir).select(*MODEL))
    bad = F.when(F.col("booking_id") == "13", F.raise_error(F.lit("bad row")).cast("string")).otherwise(F.col("ptf_no"))
    build = lambda ids: _rebuild(spark, sf_dir)(ids).withColumn("ptf_no", bad)
    return RF.refresh_read_model(tables(spark, sf_dir)["pod"].where("booking_id LIKE '%3'").select("booking_id"), model, build)


@query
def process_events(spark, sf_dir):
    """Two runs over the same events: the first fails for bookings ending in 5, the second does those only."""
    root = scratch(spark, "process")
    events = D.detect_ar(whole_tables(spark, sf_dir), AS_OF, LOOKBACK).withColumn("position", last_segment(F.col("serial")))
    partial = lambda ids: ids.where(~F.col("booking_id").endswith("5"))
    RF.process_events(events, partial, root, AS_OF)
    RF.process_events(events, lambda ids: ids, root, AS_OF)
    return ledger_for(spark, root, AS_OF).select("id", "serial")


@query
def refresh_stream(spark, sf_dir):
    """Documents landing as a stream; each arrival detects and processes, and the ledger stops repeats."""
    root = scratch(spark, "refresh")
    source = spark.readStream.schema(roles.GIVEN["events"]).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    t = tables(spark, sf_dir)
    detect = lambda: P.fetch_events(t, AS_OF, lookback_days=LOOKBACK).withColumn("position", -F.col("stamp"))
    process = lambda events: RF.process_events(events, lambda ids: ids, f"{root}/ledger", AS_OF)
    refresh_on_arrival(source, detect, process, f"{root}/checkpoint", "available_now").awaitTermination()
    return ledger_for(spark, f"{root}/ledger", AS_OF).select("id", "serial")


@query
def refresh_on_change(spark, sf_dir):
    """All tables as changes in two batches, with rows that leave again: the events are those of a full pass."""
    root = scratch(spark, "delta")
    t = tables(spark, sf_dir)
    given = {n: t[n].select(*schema.names) for n, schema in DL.INPUTS.items()}
    late = F.pmod(F.hash("doc_entry"), F.lit(10)) == 0
    second = {n: given[n].where(late) for n in ("receivable_head", "receivable_line")}
    first = {n: df.where(~late) if n in second else df for n, df in given.items()}
    # What the first batch holds too much, and the second takes back.
    extra = {"order_head": given["order_head"].where(late).withColumn("doc_num", F.col("doc_num") + 1), "order_line": given["order_line"].where(late)}
    first |= {n: first[n].unionByName(df) for n, df in extra.items()}
    second |= {n: df.withColumn("weight", F.lit(-1).cast("bigint")) for n, df in extra.items()}
    landed = lambda: spark.readStream.schema("`table` string, weight bigint, row string").parquet(f"{root}/landing")
    detection = DL.DeltaDetection(spark, f"{root}/state", AS_OF, LOOKBACK, buckets=8)
    for batch in (first, second):
        DL.as_changes(batch).write.mode("append").parquet(f"{root}/landing")
        polling.refresh_on_change(landed(), detection, lambda events: None, f"{root}/checkpoint", trigger="available_now").awaitTermination()
    return _fetched(detection.fetch())


@query
def append_and_read_ledger(spark, sf_dir):
    root = scratch(spark, "ledger")
    events = roles.ledger(spark, sf_dir)
    append_ledger(events.where("id LIKE '%1'"), root, "1998-05-31")
    append_ledger(events.where("id NOT LIKE '%1'"), root, AS_OF)
    return ledger_for(spark, root, AS_OF).select("id", "serial", day("day"))


# --- scalars --------------------------------------------------------------------------------------------


@query
def scalar_functions(spark, sf_dir):
    c = F.col
    clock = Clock("1998-06-01 13:05:09")
    late = Clock("1998-06-01 13:05:09", legacy_12h=True)
    head = D.changed_heads(roles.heads(spark, sf_dir), "AP", AS_OF, 100_000)
    return head.select(
        "doc_num",
        "serial",
        X.concat_text(c("pv_no"), "/", c("doc_num")).alias("joined"),
        day_text(c("create_date")).alias("day_text"),
        clock.stamp().alias("now_stamp"),
        late.stamp().alias("now_stamp_12h"),
        X.squeeze(c("pv_no")).alias("squeezed"),
        F.array_join(X.tokens(c("pv_no")), "|").alias("tokens"),
        F.coalesce("pv_no", F.lit("none")).alias("or_default"),
        last_segment(c("serial")).alias("segment"),
        serial_stamp(c("serial")).cast("bigint").alias("stamp"),
        legacy_stamp(c("serial")).cast("bigint").alias("legacy_stamp"),
        X.parse_number(F.concat(c("doc_num").cast("string"), F.lit(",000.5"))).alias("parsed"),
        F.nullif("pv_no", F.lit("")).alias("null_if"),
        F.datediff("update_date", "create_date").alias("days"),
        F.substring("pv_no", 2, 3).alias("part"),
    )


@query
def exploded_tokens(spark, sf_dir):
    cell = roles.tp(spark, sf_dir)
    return cell.select("booking_id", F.explode(X.tokens(F.col("pv_no"))).alias("token"))


@query
def penalty_metrics(spark, sf_dir):
    view = V.build_booking_view(tables(spark, sf_dir), AS_OF)
    return _view_out(
        view.select(
            "booking_id", "client_sub_overdue", "client_penalty", "submit_deadline", "overdue_days", "payment_status",
            "carrier_penalty", "lost_penalty", "total_sub_penalties", "total_penalty_waived",
        )
    )


@query
def sql_penalty_metrics(spark, sf_dir):
    """The metrics by a SQL text that calls the functions by name."""
    register_functions(spark)
    t = tables(spark, sf_dir)
    star = V.enrich_booking(t["pod"], t["billing"], t["tp"], t["pricing"], t["partner"])
    metrics = spark.sql(
        f"""SELECT s.booking_id, p.* FROM (
            SELECT *, net_of_vat(pricing_gross_rates, carrier_vat_status) + net_of_vat(pricing_demurrage2, carrier_vat_status)
                + net_of_vat(pricing_addtl_drop + pricing_boom_truck + pricing_manpower + pricing_backload, carrier_vat_status)
                AS carrier_total FROM {{star}}) s,
            LATERAL booking_penalties(delivery_date, client_received, actual_received, waived_days, client_cdc, client_dcd,
                holiday_days, carrier_total, penalties_manual, perc_penalty, DATE'{AS_OF}') p""",
        star=star,
    )
    return _view_out(metrics)


@query
def sql_cell_tokens(spark, sf_dir):
    """Tokens of the bookings' reference cells, through the table function."""
    register_functions(spark)
    return spark.sql(
        "SELECT booking_id, position, token, cell_has(pv_no, token) AS known FROM {tp}, LATERAL cell_tokens(pv_no)",
        tp=roles.tp(spark, sf_dir),
    )


@query
def net_of_vat(spark, sf_dir):
    rates = roles.pricing(spark, sf_dir).withColumn("carrier", F.expr("concat('S', CAST(booking_id AS BIGINT) % 120)"))
    carriers = roles.partner(spark, sf_dir).select(F.col("code").alias("carrier"), "vat_status")
    return rates.join(carriers, "carrier", "left").select(
        "booking_id", M.net_of_vat(F.col("gross_rates"), F.col("vat_status")).alias("net")
    )


@query
def scrub_rates(spark, sf_dir):
    ids = roles.pod(spark, sf_dir).where("status_detail = 'Verified'").select("booking_id")
    return RF.scrub_rates(roles.rates_staging(spark, sf_dir), ids)


# --- locks ----------------------------------------------------------------------------------------------


def _hold_rows(df: DataFrame) -> DataFrame:
    return df.select(
        "grp", "row_id", "client", at_id("enter", "enter_id"), at_id("leave", "leave_id"),
        at_id("granted_at", "granted_id"),
    )


@query
def lock_holds(spark, sf_dir):
    return _hold_rows(holds(spark, sf_dir))


@query
def lock_ids(spark, sf_dir):
    held = L.with_lock_id(holds(spark, sf_dir)).where("granted_at IS NOT NULL")
    return held.select("grp", "row_id", "client", at_id("granted_at", "granted_id"), "lock_id")


@query
def release_payloads(spark, sf_dir):
    return payload(L.release_notices(holds(spark, sf_dir))).select("event_id", "recipient", "payload")


@query
def queue_position(spark, sf_dir):
    return holds(spark, sf_dir).select("grp", "row_id", "client", at_id("enter", "enter_id"), "queue_position")


@query
def registration_replies(spark, sf_dir):
    asked = requests(spark, sf_dir)
    replies = L.registration_replies(L.held_rows(asked, holds(spark, sf_dir, asked)))
    return replies.select(
        "event_id", "recipient", "session_id", "grp", F.array_join("ids", ",").alias("ids"),
        F.array_join("id_info.user_name", ",").alias("holders"),
    )


@query
def release_notices(spark, sf_dir):
    sent = L.release_notices(holds(spark, sf_dir))
    return sent.select("event_id", "recipient", "grp", F.element_at("ids", 1).alias("row_id"))


@query
def unlock_requests(spark, sf_dir):
    asked = requests(spark, sf_dir)
    sent = L.unlock_requests(L.held_rows(asked, holds(spark, sf_dir, asked)))
    return sent.select(
        "event_id", "recipient", "session_id", "status", "grp", F.element_at("ids", 1).alias("row_id"),
        F.col("requestor.client").alias("requestor"),
    )


@query
def update_recipients(spark, sf_dir):
    asked = requests(spark, sf_dir)
    sent = L.update_recipients(asked, L.waits(holds(spark, sf_dir, asked)))
    return sent.select(at_id("at", "event_id"), "sender", "recipient", "grp")


_OUT = ["event_id", "kind", "recipient", "session_id", "event", "status", "grp"]


@query
def outbox(spark, sf_dir):
    asked = requests(spark, sf_dir)
    sent = L.route_messages(asked, materialize(holds(spark, sf_dir, asked)))
    return sent.select(*_OUT, F.array_join("ids", ",").alias("ids"))


_STREAMS: dict[tuple[str, str], LockStream] = {}


def _streamed(spark, sf_dir) -> LockStream:
    """The message log landing in three slices in time order, each worked off as it lands; run once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STREAMS:
        root = scratch(spark, "locks")
        log = roles.message_log(spark, sf_dir)
        bounds = log.agg(F.min("event_id"), F.max("event_id")).first()
        width = (bounds[1] - bounds[0]) // 3 + 1
        stream = LockStream(spark, f"{root}/out", delay="0 seconds")
        for low in range(bounds[0], bounds[1] + 1, width):
            log.where(F.col("event_id").between(low, low + width - 1)).write.mode("append").parquet(f"{root}/in")
            source = spark.readStream.schema(log.schema).parquet(f"{root}/in")
            stream.start(source, f"{root}/checkpoint", "available_now").awaitTermination()
        _STREAMS[key] = stream
    return _STREAMS[key]


def _keyed(spark, sf_dir) -> KeyedLocks:
    """The message log landing in two slices in time order, each worked off by the keyed streams as it lands."""
    root = scratch(spark, "keyed")
    log = roles.message_log(spark, sf_dir)
    middle = log.agg(F.avg("event_id").cast("bigint")).first()[0]
    locks = KeyedLocks(spark, f"{root}/out")
    for part in (F.col("event_id") <= middle, F.col("event_id") > middle):
        log.where(part).write.mode("append").parquet(f"{root}/in")
        locks.run_available(spark.readStream.schema(log.schema).parquet(f"{root}/in"))
    return locks


@query
def keyed_lock_holds(spark, sf_dir):
    return _hold_rows(_keyed(spark, sf_dir).holds())


@query
def keyed_lock_outbox(spark, sf_dir):
    return _keyed(spark, sf_dir).outbox().select(*_OUT, F.array_join("ids", ",").alias("ids"))


@query
def keyed_lock_rejects(spark, sf_dir):
    return _keyed(spark, sf_dir).rejects().select("event_id", "reason")


@query
def lock_stream_holds(spark, sf_dir):
    stream = _streamed(spark, sf_dir)
    last = stream.table("open").agg(F.max("batch")).scalar()
    running = stream.table("open").where(F.col("batch") == last)
    return _hold_rows(stream.table("holds").unionByName(running))


@query
def lock_stream_outbox(spark, sf_dir):
    return _streamed(spark, sf_dir).table("outbox").select(*_OUT, F.array_join("ids", ",").alias("ids"))


@query
def lock_stream_rejects(spark, sf_dir):
    return _streamed(spark, sf_dir).table("dead").select("event_id", "reason")
