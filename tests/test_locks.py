import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidemark.operators.filters import split_locks
from tidemark.operators.locks import route_messages
from tidemark.plans.lock_history import lock_history, read_requests
from tidemark.schemas import GROUPS, MESSAGE_LOG
from tidemark.session import materialize
from tidemark.sources.messages import dispatch, parse_messages, payload, to_requests
from tidemark.streaming.keyed_locks import KeyedLocks
from tidemark.streaming.lock_stream import LockStream

START = datetime(2024, 1, 1)


def message(kind, event, client, **prop):
    data = {"clientId": client, "userId": f"id{client}", "userName": f"name{client}"}
    if prop:
        data["prop"] = prop
    return json.dumps({"sessionId": f"s{client}", "type": kind, "event": event, "data": data})


def random_log(seed, n):
    """(event_id, ts, text, what it asks) with equal timestamps, several ids per message and one busy row."""
    rng = random.Random(seed)
    log, at = [], START
    for i in range(n):
        at += timedelta(seconds=rng.choice([0, 0, 1, 40, 3000]))
        client, group = rng.choice("abcdef"), rng.choice(["pod", "pod", "tp"])
        ids = rng.sample(["1", "1", "2", "3"], rng.choice([1, 1, 2]))
        kind = rng.choice(["register"] * 4 + ["clean_up", "clean_group", "ask", "update", "noise"])
        text = {
            "register": message("MESSAGE", "REGISTRATION", client, group=group, ids=ids),
            "clean_up": message("MESSAGE", "CLEAN_UP", client),
            "clean_group": message("MESSAGE", "CLEAN_UP", client, group=group),
            "ask": message("MESSAGE", "ASK_TO_UNLOCK", client, group=group, id=ids[0]),
            "update": message("BROADCAST", "UPDATE", client, group=group, ids=ids),
            "noise": rng.choice(["", "{", "[]", "{}", "3", message("MESSAGE", "CONNECTION_ESTABLISHED", client)]),
        }[kind]
        log.append((i, at, text, (kind, client, group, list(dict.fromkeys(ids)))))
    return log


def replay(log):
    """The protocol one message at a time: stints and the outbox."""
    rows, stints, out = {}, [], []
    for i, _, _, (kind, client, group, ids) in log:
        if kind == "register":
            locked = []
            for row in ids:
                queue = rows.setdefault((group, row), [])
                if queue:
                    locked.append(row)
                if client not in [s["client"] for s in queue]:
                    stint = {"row": (group, row), "client": client, "enter": i, "leave": None, "granted": None if queue else i}
                    stint["position"] = len(queue)
                    queue.append(stint)
                    stints.append(stint)
            out.append((i, client, "REGISTRATION", None, group, ",".join(locked)))
        elif kind in ("clean_up", "clean_group"):
            for (grp, row), queue in rows.items():
                if kind == "clean_group" and grp != group:
                    continue
                for stint in [s for s in queue if s["client"] == client]:
                    first = queue[0] is stint
                    queue.remove(stint)
                    stint["leave"] = i
                    if first and queue:
                        queue[0]["granted"] = i
                        out.append((i, queue[0]["client"], "RELEASE", None, grp, row))
        elif kind == "ask":
            queue = rows.get((group, ids[0]))
            to, status = (queue[0]["client"], "REQUEST") if queue else (client, "FAILED")
            out.append((i, to, "ASK_TO_UNLOCK", status, group, ids[0]))
        elif kind == "update":
            waiting = {s["client"] for row in ids for s in rows.get((group, row), [])[1:]} - {client}
            out += [(i, to, "UPDATE", None, group, ",".join(ids)) for to in waiting]
    return stints, out


def stint_rows(holds):
    got = holds.select("grp", "row_id", "client", "enter.event_id", "leave.event_id", "granted_at.event_id").collect()
    return sorted(map(tuple, got), key=str)


def expected_stints(stints):
    return sorted([(*s["row"], s["client"], s["enter"], s["leave"], s["granted"]) for s in stints], key=str)


def outbox_rows(df):
    got = df.select("event_id", "recipient", "event", "status", "grp", F.array_join("ids", ",")).collect()
    return sorted(map(tuple, got), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_history_and_outbox_are_the_replay(frame, seed):
    log = random_log(seed, 300)
    stints, out = replay(log)
    requests = read_requests(frame([r[:3] for r in log], MESSAGE_LOG))
    holds = materialize(lock_history(requests, parts=5))
    assert stint_rows(holds) == expected_stints(stints)
    positions = {(r.grp, r.row_id, r.client, r.enter.event_id): r.queue_position for r in holds.collect()}
    assert positions == {(*s["row"], s["client"], s["enter"]): s["position"] for s in stints}
    assert outbox_rows(route_messages(requests, holds, parts=5)) == sorted(out, key=str)


def test_stream_is_the_batch(spark, frame, tmp_path):
    log = random_log(4, 240)
    rng = random.Random(9)
    stints, out = replay(log)
    stream = LockStream(spark, str(tmp_path / "out"), delay="0 seconds", parts=3)
    source = str(tmp_path / "in")
    low = 0
    for high in [*sorted(rng.sample(range(1, 240), 2)), 240]:
        # Each landing comes in another order than the log's.
        frame(rng.sample([r[:3] for r in log[low:high]], high - low), MESSAGE_LOG).write.mode("append").parquet(source)
        low = high
        landed = spark.readStream.schema(MESSAGE_LOG).parquet(source)
        stream.start(landed, str(tmp_path / "checkpoint"), "available_now").awaitTermination()
    opened = stream.table("open").where("batch = 2")
    assert stint_rows(stream.table("holds").unionByName(opened)) == expected_stints(stints)
    assert outbox_rows(stream.table("outbox")) == sorted(out, key=str)

    # Running a batch again rewrites the same results.
    stream.handle(spark.read.schema(MESSAGE_LOG).parquet(source).where(f"event_id >= {low}"), 3)
    again = stint_rows(stream.table("open").where("batch = 3"))
    assert again == stint_rows(opened)


def test_keyed_state_is_the_batch(spark, frame, tmp_path):
    log = random_log(5, 240)
    rng = random.Random(9)
    stints, out = replay(log)
    locks, source = KeyedLocks(spark, str(tmp_path / "out")), str(tmp_path / "in")
    for low, high in ((0, 170), (170, 240)):
        frame(rng.sample([r[:3] for r in log[low:high]], high - low), MESSAGE_LOG).write.mode("append").parquet(source)
        locks.run_available(spark.readStream.schema(MESSAGE_LOG).parquet(source))
    assert stint_rows(locks.holds()) == expected_stints(stints)
    positions = {(r.grp, r.row_id, r.client, r.enter.event_id): r.queue_position for r in locks.holds().collect()}
    assert positions == {(*s["row"], s["client"], s["enter"]): s["position"] for s in stints}
    assert outbox_rows(locks.outbox()) == sorted(out, key=str)


def test_keyed_state_follows_the_batch(spark, frame, tmp_path):
    ask = lambda i, s, c=None: (i, None if s is None else START + timedelta(seconds=s), message("MESSAGE", "REGISTRATION", c or f"c{i}", group="pod", ids=["1"]))
    leave = lambda i, s, c: (i, START + timedelta(seconds=s), message("MESSAGE", "CLEAN_UP", c))
    locks, source, updated = KeyedLocks(spark, str(tmp_path / "out")), str(tmp_path / "in"), []
    batches = [
        [ask(i, i) for i in range(1, 301)] + [(900, START, "{"), ask(901, None)],
        # Too late for the row; a repeated registration; a new one; a late clean-up frees the lock all the same.
        [ask(902, 5, "x"), ask(903, 400, "c7"), ask(904, 401, "y"), leave(905, 100, "c1"), leave(906, 402, "c2")],
    ]
    for batch in batches:
        frame(batch, MESSAGE_LOG).write.mode("append").parquet(source)
        for query in locks.start_steps(spark.readStream.schema(MESSAGE_LOG).parquet(source), "available_now"):
            query.awaitTermination()
        query = locks.start_facts("available_now")
        query.awaitTermination()
        updated.append(sum(o["numRowsUpdated"] for p in query.recentProgress for o in p["stateOperators"]))
    assert updated[0] >= 600 and updated[1] < 30, "a queue of 300 is not written again"
    assert {(r.event_id, r.reason) for r in locks.rejects().collect()} == {(900, "malformed"), (901, "undated"), (902, "late")}
    held = {r.client: (r.enter.event_id, r.leave and r.leave.event_id, r.granted_at and r.granted_at.event_id, r.queue_position) for r in locks.holds().collect()}
    assert held["c1"] == (1, 905, 1, 0) and held["c7"] == (7, None, None, 6) and held["y"] == (904, None, None, 299)
    assert held["c2"][:2] == (2, 906) and held["c2"][2] is not None and held["c3"][2] is not None and "x" not in held


def test_late_and_pending_requests(spark, frame, tmp_path):
    stream = LockStream(spark, str(tmp_path), delay="10 seconds", parts=2)
    ask = lambda i, s: (i, START + timedelta(seconds=s), message("MESSAGE", "REGISTRATION", f"c{i}", group="pod", ids=["1"]))
    stream.handle(frame([ask(1, 0), ask(3, 30)], MESSAGE_LOG), 0)
    assert stream.table("pending").count() == 1
    stream.handle(frame([ask(2, 25), ask(5, 60), (6, START, "{")], MESSAGE_LOG), 1)
    held = {r.client: r.granted_at for r in stream.table("open").where("batch = 1").collect()}
    assert set(held) == {"c1", "c2", "c3"} and held["c1"].event_id == 1 and held["c2"] is None
    stream.handle(frame([ask(4, 20)], MESSAGE_LOG), 2)
    dead = {(r.event_id, r.reason) for r in stream.table("dead").collect()}
    assert dead == {(6, "malformed"), (4, "late")}


def test_undated_requests_and_lost_state(spark, frame, tmp_path):
    stream = LockStream(spark, str(tmp_path), delay="0 seconds", parts=2)
    text = lambda i: message("MESSAGE", "REGISTRATION", f"c{i}", group="pod", ids=["1"])
    stream.handle(frame([(1, START, text(1)), (2, None, text(2))], MESSAGE_LOG), 0)
    assert {(r.event_id, r.reason) for r in stream.table("dead").collect()} == {(2, "undated")}
    with pytest.raises(AnalysisException):
        stream.handle(frame([(3, START, text(3))], MESSAGE_LOG), 5)


def test_messages(frame):
    good = message("MESSAGE", "REGISTRATION", "a", group="pod", ids=["1", "1", "2"])
    texts = [good, "", "[]", " { } ", "null", '"{a}"', "7", "{", '{"a":1} x', "[1],[2]", "{'a':1}", "[1]", ' {"type":"X"}',
             message("MESSAGE", "REGISTRATION", "a", group="nope", ids=["1"]), message("BROADCAST", "REGISTRATION", "a")]
    valid, rejected = parse_messages(frame([(i, START, t) for i, t in enumerate(texts)], MESSAGE_LOG))
    assert sorted(r.event_id for r in valid.collect()) == [0, 11, 12, 13, 14]
    assert rejected.count() == 10
    usable, invalid = to_requests(dispatch(valid))
    (only,) = usable.collect()
    assert (only.route, only.client, only.grp, only.ids) == ("register", "a", "pod", ["1", "2"])
    assert [r["at"].event_id for r in invalid.collect()] == [13]


def test_payload_round_trip(frame):
    log = [
        (1, START, message("MESSAGE", "REGISTRATION", "a", group="pod", ids=["1"])),
        (2, START, message("MESSAGE", "REGISTRATION", "b", group="pod", ids=["1", "2"])),
        (3, START, message("MESSAGE", "ASK_TO_UNLOCK", "b", group="pod", id="1")),
        (4, START, message("BROADCAST", "UPDATE", "a", group="pod", ids=["1"])),
    ]
    requests = read_requests(frame(log, MESSAGE_LOG))
    sent = payload(route_messages(requests, lock_history(requests, parts=2), parts=2)).collect()
    got = {(r.event_id, r.recipient): json.loads(r.payload) for r in sent}
    assert got[(2, "b")]["data"]["prop"] == {
        "group": "pod", "ids": ["1"],
        "idInfo": [{"id": "1", "userInfo": {"clientId": "a", "userId": "ida", "userName": "namea"}}],
    }
    asked = got[(3, "a")]
    assert asked["data"]["status"] == "REQUEST" and asked["data"]["requestorInfo"]["clientId"] == "b"
    assert asked["sessionId"] == "" and asked["data"]["prop"] == {"group": "pod", "id": "1"}
    assert got[(4, "b")]["event"] == "UPDATE" and got[(4, "b")]["data"]["clientId"] == "a"


def test_split_locks(frame):
    locks = frame([("a", "pod"), ("a", "tp"), ("b", "pod"), (None, "tp")], "client string, grp string")
    kept, gone = split_locks(locks, "a", "pod")
    assert gone.collect() == [("a", "pod")] and kept.count() == 3
    assert split_locks(locks, "a")[0].count() == 2
    assert set(GROUPS) == {"pod", "billing", "tp", "pricing"}
