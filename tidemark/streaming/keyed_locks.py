"""The lock protocol with keyed state: first by client, then by row.

Two streaming queries. The first knows which rows each client has asked for, so that a repeated registration opens nothing and a
clean-up names the rows it leaves; it appends one step for each row that a request is about. The second reads the steps and keeps each row's
queue. State is kept by entry, in map state: of a batch, each client's rows and each place of a queue are read and written once at most, and
what a batch writes follows the batch. Requests are worked off in the order (ts, event_id) within a batch; one that is older than what its
client or row has worked off in an earlier batch is late, and so listed, but a late clean-up still takes effect.

Whom an update is told to grows with updates times queues, so the state hands on the update itself with its number in the row's order; its
recipients are found by a join when the outbox is read. A batch's requests about one row are put in order in one task, and so are those of the
clients that share a bucket; the source's options bound a batch.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce
from itertools import groupby, islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from tidemark.operators.intervals import stab_join
from tidemark.operators.locks import INFO, registration_replies, release_notices, unlock_requests, update_outbox, update_texts
from tidemark.schemas import GROUPS
from tidemark.sources.messages import payload, sort_requests
from tidemark.streaming.polling import POLL_INTERVAL

SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
# Rows that a key's task holds before it hands them on.
CHUNK = 10_000
# Buckets of clients (the first query's keys; its state is laid out by them), and row ids in an entry of a client's rows.
BUCKETS = 1_024
SLOT = 1_000
REGISTER, LEAVE, ASK, UPDATE, LATE = "register", "leave", "ask_to_unlock", "update", "late"
ASKED = "ts timestamp_ntz, event_id bigint, kind string, session_id string, client string, user_id string, user_name string, grp string, row_id string, pos int, ids array<string>"
#: ``entered``: of a registration, whether it opens a stint; of a clean-up's step, the stint's begin is known to the row.
STEP = f"{ASKED}, entered boolean"
#: ``kind`` is ``late``, ``answer`` (with the holder before the request), ``enter``, ``granted``, ``left`` or ``update`` (while someone waits).
#: ``seq``: the request's number among those that the row has worked off.
FACT = """kind string, ts timestamp_ntz, event_id bigint, asked string, session_id string, client string, user_id string, user_name string, grp string, row_id string, pos int,
 ids array<string>, enter_ts timestamp_ntz, enter_event bigint, queue_position bigint, other string, other_id string, other_name string, seq bigint"""
NEVER = (-(2**62), 0)


def _names(ddl: str) -> list[str]:
    return [part.split()[0] for part in ddl.replace("\n", " ").split(", ")]


def _rows(frames: Iterator[pd.DataFrame], ddl: str) -> list[tuple]:
    """Rows of the columns of ``ddl``; times are whole microseconds."""
    names = _names(ddl)
    micros = lambda times: pd.to_datetime(times).astype("datetime64[us]").astype("int64")
    return [row for f in frames for row in zip(*[(micros(f[n]) if n == "ts" else f[n]).tolist() for n in names], strict=True)]


def _place_in_order(r: tuple) -> tuple:
    """The order of the protocol, of rows that begin like ``ASKED``."""
    return r[0], r[1], r[2] != LEAVE, r[9]


def _in_chunks(rows: Iterator[tuple], names: list[str]) -> Iterator[pd.DataFrame]:
    """Frames of at most ``CHUNK`` rows, so that a key with very many holds none of the others."""
    none = np.iinfo("int64").min
    while chunk := list(islice(rows, CHUNK)):
        # As objects, whole numbers beside gaps stay exact.
        frame = pd.DataFrame(chunk, columns=names, dtype=object)
        for name in {"ts", "enter_ts"} & set(names):
            frame[name] = np.array([none if v is None else v for v in frame[name]], dtype="int64").view("datetime64[us]")
        yield frame


class ClientRows(StatefulProcessor):
    """Of the clients of a bucket, by group: the rows each has asked for, and its request worked off last.

    ``clients`` has for each group of a client the last request and how many rows are open; ``open`` has the rows, ``SLOT`` in an entry.
    """

    def init(self, handle) -> None:
        self.clients = handle.getMapState("clients", "client string", "groups string")
        self.open = handle.getMapState("open", "client string, grp string, slot int", "row_ids string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        yield from _in_chunks(self._steps(rows), _names(STEP))

    def _steps(self, rows) -> Iterator[tuple]:
        asked = []
        for r in _rows(rows, ASKED):
            if r[2] in (REGISTER, LEAVE):
                asked.append(r)
            else:
                yield (*r, False)
        asked.sort(key=lambda r: (r[4], _place_in_order(r)))
        for client, of_client in groupby(asked, key=lambda r: r[4]):
            yield from self._of_client(client, of_client)

    def _of_client(self, client: str, asked: Iterator[tuple]) -> Iterator[tuple]:
        stored = self.clients.getValue((client,))
        groups = json.loads(stored[0]) if stored else {}
        newest, rows, same = {g: (m, e) for g, (m, e, _) in groups.items()}, {}, {}
        for ts, event_id, kind, session_id, _, user_id, user_name, grp, row_id, pos, ids in asked:
            at = (ts, event_id)
            # A clean-up without a group has an empty one here.
            for g in (grp,) if grp else GROUPS:
                if g not in rows:
                    same[g] = groups[g][2] if g in groups else 0
                    rows[g] = {i: None for slot in range(-(-same[g] // SLOT)) for i in json.loads(self.open.getValue((client, g, slot))[0])}
                newest[g] = max(newest.get(g, NEVER), at)
                if kind == LEAVE:
                    for left in sorted(rows[g]):
                        yield (ts, event_id, LEAVE, session_id, client, user_id, user_name, g, left, 0, ids, False)
                    rows[g], same[g] = {}, 0
                    continue
                late = g in groups and at <= tuple(groups[g][:2])
                entered = not late and row_id not in rows[g]
                if entered:
                    rows[g][row_id] = None
                yield (ts, event_id, LATE if late else REGISTER, session_id, client, user_id, user_name, g, row_id, pos, ids, entered)
        for g, now in rows.items():
            ids, needed = list(now), -(-len(now) // SLOT)
            if len(ids) > same[g]:
                for slot in range(same[g] // SLOT, needed):
                    self.open.updateValue((client, g, slot), (json.dumps(ids[slot * SLOT : (slot + 1) * SLOT]),))
            for slot in range(needed, -(-(groups[g][2] if g in groups else 0) // SLOT)):
                self.open.removeKey((client, g, slot))
        held = {g: [*at, len(rows[g]) if g in rows else groups[g][2]] for g, at in newest.items()}
        if held != groups:
            self.clients.updateValue((client,), (json.dumps(held),))

    def close(self) -> None:
        pass


class RowQueue(StatefulProcessor):
    """Of one row: its queue by place, each client's place, and ``head`` (the holder's place), ``next``, how many are present, the last request and its number."""

    def init(self, handle) -> None:
        self.queue = handle.getMapState("queue", "place long", "client string, user_id string, user_name string, micros long, event_id long")
        self.places = handle.getMapState("places", "client string", "place long")
        self.state = handle.getValueState("state", "head long, next long, present long, micros long, event_id long, seq long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        yield from _in_chunks(self._facts(rows), _names(FACT))

    def _facts(self, rows) -> Iterator[tuple]:
        steps = sorted(_rows(rows, STEP), key=_place_in_order)
        head, next_, present, *last, seq = self.state.get() if self.state.exists() else (0, 0, 0, *NEVER, 0)
        done, last, first_new = tuple(last), tuple(last), next_
        # Entries as far as they were asked for (None: not there), which are written back at the end.
        queue, places, stored, whole = {}, {}, {}, False
        if 0 < present <= len({r[4] for r in steps if r[2] == LEAVE or r[-1]}):
            queue = {place: entry for (place,), entry in self.queue.iterator()}
            places, whole = {entry[0]: place for place, entry in queue.items()}, True
            stored = dict(places)

        def place_of(client):
            if client not in places and not whole and present:
                found = self.places.getValue((client,))
                places[client] = stored[client] = found[0] if found else None
            return places.get(client)

        def entry_at(place):
            if place not in queue and not whole and place < first_new:
                queue[place] = self.queue.getValue((place,))
            return queue.get(place)

        for ts, event_id, kind, session_id, client, user_id, user_name, grp, row_id, pos, ids, opens in steps:
            at = (ts, event_id)
            asked = (ts, event_id, kind, session_id, client, user_id, user_name, grp, row_id, pos, ids)
            if kind == LATE or (kind != LEAVE and at <= done):
                yield (LATE, *asked, None, None, None, None, None, None, None)
                continue
            last, seq = max(last, at), seq + 1
            if kind == LEAVE:
                place = place_of(client)
                if place is None:
                    continue
                gone = entry_at(place)
                queue[place] = places[client] = None
                present -= 1
                yield ("left", ts, event_id, kind, session_id, *gone[:3], grp, row_id, pos, ids, *gone[3:], None, None, None, None, seq)
                if place == head and present:
                    head += 1
                    while entry_at(head) is None:
                        head += 1
                    turn = entry_at(head)
                    yield ("granted", *last, kind, session_id, *turn[:3], grp, row_id, pos, ids, *turn[3:], None, None, None, None, seq)
                continue
            if kind == UPDATE:
                if present > 1:
                    yield (UPDATE, *asked, None, None, None, None, None, None, seq)
                continue
            holder = entry_at(head)[:3] if present else (None, None, None)
            yield ("answer", *asked, None, None, None, *holder, seq)
            if kind == REGISTER and opens and place_of(client) is None:
                queue[next_], places[client] = (client, user_id, user_name, ts, event_id), next_
                yield ("enter", *asked, ts, event_id, present, None, None, None, seq)
                if not present:
                    head = next_
                    yield ("granted", *asked, ts, event_id, None, None, None, None, seq)
                present, next_ = present + 1, next_ + 1
        for client, place in places.items():
            before = stored.get(client)
            if place == before:
                continue
            if before is not None:
                self.queue.removeKey((before,))
            if place is None:
                self.places.removeKey((client,))
            else:
                self.queue.updateValue((place,), queue[place])
                self.places.updateValue((client,), (place,))
        self.state.update((head, next_, present, *last, seq))

    def close(self) -> None:
        pass


@contextmanager
def _settings(spark: SparkSession):
    """The state store that map state asks for; a query keeps the settings it was started with."""
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    try:
        for k, v in SETTINGS.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def _requests(log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable requests of a log, and what is left out of it with the reason."""
    # Parsing is dealt out by message, however few files a batch landed in.
    parts = int(log.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = sort_requests(log.select("event_id", "ts", "text").repartition(parts, "event_id"))
    dead = found.where("reason IS NOT NULL OR at.ts IS NULL").select("at.event_id", "at.ts", F.coalesce("reason", F.lit("undated")).alias("reason"))
    return found.where("reason IS NULL AND at.ts IS NOT NULL").drop("reason"), dead


def _asked(requests: DataFrame) -> DataFrame:
    """A row for each row that a request names (``ASKED``); a clean-up is one, with an empty group if it concerns all."""
    leaves = F.col("route") == "clean_up"
    unless = lambda name: F.when(~leaves, F.col(name)).alias(name)
    named = requests.select(
        F.col("at.ts").alias("ts"), F.col("at.event_id").alias("event_id"), F.when(leaves, LEAVE).otherwise(F.col("route")).alias("kind"),
        unless("session_id"), "client", unless("user_id"), unless("user_name"), F.when(leaves, F.coalesce("grp", F.lit(""))).otherwise(F.col("grp")).alias("grp"),
        F.posexplode(F.when(leaves, F.array(F.lit(""))).otherwise(F.col("ids"))).alias("pos", "row_id"), unless("ids"),
    )
    return named.select(*_names(ASKED))


@dataclass(frozen=True)
class KeyedLocks:
    """The protocol under ``root``: ``steps`` and ``facts`` (appended by the two queries), and ``rejects`` of the log."""

    spark: SparkSession
    root: str

    def _sink(self, df: DataFrame, name: str, trigger: str) -> StreamingQuery:
        when = {"availableNow": True} if trigger == "available_now" else {"processingTime": trigger}
        out = df.writeStream.format("parquet").option("path", f"{self.root}/{name}").option("checkpointLocation", f"{self.root}/checkpoints/{name}")
        with _settings(self.spark):
            return out.outputMode("append").trigger(**when).start()

    def start_steps(self, log: DataFrame, trigger: str = POLL_INTERVAL) -> list[StreamingQuery]:
        requests, dead = _requests(log)
        bucketed = _asked(requests).withColumn("bucket", F.pmod(F.xxhash64("client"), F.lit(BUCKETS)).cast("int"))
        steps = bucketed.groupBy("bucket").transformWithStateInPandas(ClientRows(), STEP, "Append", "None")
        return [self._sink(steps, "steps", trigger), self._sink(dead, "rejects", trigger)]

    def start_facts(self, trigger: str = POLL_INTERVAL) -> StreamingQuery:
        """Once ``steps`` is there."""
        steps = self.spark.readStream.schema(STEP).parquet(f"{self.root}/steps")
        facts = steps.groupBy("grp", "row_id").transformWithStateInPandas(RowQueue(), FACT, "Append", "None")
        return self._sink(facts, "facts", trigger)

    def run_available(self, log: DataFrame) -> None:
        """Work off what has landed, and stop."""
        for query in self.start_steps(log, "available_now"):
            query.awaitTermination()
        self.start_facts("available_now").awaitTermination()

    def facts(self, *kinds: str) -> DataFrame:
        return self.spark.read.schema(FACT).parquet(f"{self.root}/facts").where(F.col("kind").isin(*kinds))

    def holds(self) -> DataFrame:
        """Every stint so far, as ``lock_history`` gives them."""
        at = F.struct("ts", "event_id")
        of = lambda kind: F.max(F.when(F.col("kind") == kind, at))
        stints = self.facts("enter", "granted", "left").groupBy("grp", "row_id", *INFO, F.struct(F.col("enter_ts").alias("ts"), F.col("enter_event").alias("event_id")).alias("enter"))
        found = stints.agg(of("left").alias("leave"), of("granted").alias("granted_at"), F.max("queue_position").alias("queue_position"))
        return found.withColumn("known", F.lit(False))

    def rejects(self) -> DataFrame:
        """``event_id``, ``ts``, ``reason`` of what was not worked off."""
        late = self.facts(LATE).select("event_id", "ts", F.lit("late").alias("reason")).distinct()
        return self.spark.read.schema("event_id bigint, ts timestamp_ntz, reason string").parquet(f"{self.root}/rejects").unionByName(late)

    def outbox(self) -> DataFrame:
        """One row per recipient of every message so far, with its payload."""
        at = F.struct("ts", "event_id").alias("at")
        holder = F.when(F.col("other").isNotNull(), F.struct(F.col("other").alias("client"), F.col("other_id").alias("user_id"), F.col("other_name").alias("user_name"))).alias("holder")
        held = self.facts("answer").select(at, "session_id", F.col("asked").alias("route"), *INFO, "grp", "pos", "row_id", holder)
        told = self._told()
        alone = registration_replies(held), release_notices(self.holds()), unlock_requests(held)
        return reduce(DataFrame.unionByName, [*map(payload, alone), update_outbox(told)])

    def _told(self) -> DataFrame:
        """Updates with each recipient and the payload: who waits for a row that the update names, by the row's order of requests."""
        of = lambda kind: F.min(F.when(F.col("kind") == kind, F.col("seq")))
        stints = self.facts("enter", "granted", "left").groupBy("grp", "row_id", F.col("client").alias("recipient"), "enter_ts", "enter_event")
        waited = stints.agg(of("enter").alias("enter"), of("granted").alias("turn"), of("left").alias("left")).where("turn IS NULL OR turn != enter")
        at = F.struct("ts", "event_id").alias("at")
        updates = self.facts(UPDATE).select(at, "session_id", F.col("client").alias("sender"), "grp", "ids", "row_id", "seq")
        last = updates.agg(F.max("seq")).scalar()
        spans = waited.select("grp", "row_id", "recipient", (F.col("enter") + 1).alias("_start"), F.least(F.least("turn", "left") - 1, last).alias("_end"))
        # A recipient can be told more than once only by an update that names several rows, or that the log has several times.
        again = F.count("*").over(Window.partitionBy("grp", "row_id", "at", "session_id", "sender", "ids")) > 1
        updates = update_texts(updates.withColumn("several", again | (F.size("ids") > 1)))

        def told(some: DataFrame) -> DataFrame:
            met = stab_join(some, spans.where("_start <= _end"), ["grp", "row_id"], "seq", "_start", "_end").where("recipient != sender")
            return met.select("at", "session_id", "sender", "recipient", "grp", "ids", "payload")

        return told(updates.where("NOT several")).unionByName(told(updates.where("several")).distinct())
