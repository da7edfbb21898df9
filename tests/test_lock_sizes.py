"""What a request leads to is handed on as it is found: pairs are not shuffled again, and a key's rows come in frames of bounded size."""

import pandas as pd
from pyspark.sql import DataFrameWriter

from tidemark.operators import locks as L
from tidemark.schemas import MESSAGE_LOG
from tidemark.sources.messages import dispatch, parse_messages, sort_requests, to_requests
from tidemark.streaming import keyed_locks as K
from tidemark.streaming.lock_stream import LockStream

AT = "struct<ts:timestamp_ntz,event_id:bigint>"


def test_pairs_of_one_row_updates_are_not_shuffled(frame):
    requests = frame([], f"route string, at {AT}, session_id string, client string, grp string, ids array<string>")
    waiting = frame([], f"grp string, row_id string, client string, enter {AT}, end {AT}")
    plan = L.update_recipients(requests, waiting)._jdf.queryExecution().analyzed()
    single, several = (plan.children().apply(i).toString() for i in (0, 1))
    above = lambda text: text[: text.index("Join")]
    assert "Deduplicate" not in above(single) and "Deduplicate" in above(several)


def test_an_update_of_two_rows_tells_a_recipient_once(frame):
    at = lambda s: f"named_struct('ts', timestamp_ntz'1998-06-01 00:00:0{s}', 'event_id', {s}L)"
    one = frame([(1,)], "x int")
    rows = [("['a']", 5), ("['a','a']", 6), ("['a','b']", 7)]
    asked = [one.selectExpr("'update' AS route", f"{at(s)} AS at", "'s' AS session_id", "'c' AS client", "'pod' AS grp", f"array({ids[1:-1]}) AS ids") for ids, s in rows]
    requests = asked[0].union(asked[1]).union(asked[2]).union(asked[0])
    waits = [one.selectExpr("'pod' AS grp", f"'{row}' AS row_id", "'d' AS client", f"{at(1)} AS enter", f"CAST(NULL AS {AT}) AS end") for row in "ab"]
    told = L.update_recipients(requests, waits[0].union(waits[1])).select("at.event_id", "recipient").collect()
    assert sorted(map(tuple, told)) == [(5, "d"), (6, "d"), (7, "d")]


def test_frames_of_a_key_are_bounded(monkeypatch):
    monkeypatch.setattr(K, "CHUNK", 3)
    made = []
    rows = ((made.append(i) or (i, "x")) for i in range(8))
    frames = K._in_chunks(rows, ["n", "text"])
    first = next(frames)
    assert len(first) == 3 and made == [0, 1, 2]
    assert pd.concat([first, *frames])["n"].tolist() == list(range(8))


def test_a_batch_is_parsed_once_and_an_update_has_one_text(spark, frame, monkeypatch, tmp_path):
    """A batch's tables: the texts are parsed for the first only, and an update's payload is made before its recipients are found."""
    plans = []

    def write(df):
        plans.append(df._jdf.queryExecution().analyzed().toString())
        return DataFrameWriter(df)

    monkeypatch.setattr(type(frame([(1,)], "x int")), "write", property(write))
    log = frame([(1, None, "{")], MESSAGE_LOG)
    LockStream(spark, str(tmp_path), delay="0 seconds").handle(log, 0)
    parsed = [p for p in plans if "from_json" in p or "parse_json" in p]
    assert len(parsed) == 1 and "RepartitionByExpression" in parsed[0]
    (sent,) = [p for p in plans if "to_json" in p]
    told = sent[sent.rindex("BROADCAST") :]
    assert "to_json" not in told[: told.index("Join")] and "to_json" in told[told.index("Join") :]


def test_messages_are_sorted_as_before(frame):
    good = '{"sessionId":"s","type":"MESSAGE","event":"REGISTRATION","data":{"clientId":"a","prop":{"group":"pod","ids":["1","1","2"]}}}'
    texts = [good, good.replace("pod", "x"), good.replace('"clientId":"a",', ""), good.replace('"2"', "null"), good.replace("REG", "reg"), "{", None, "[1]", '{"a":1} x', "{'a':1}"]
    texts += ['{"type":"MESSAGE","event":"CLEAN_UP","data":{"clientId":"a"}}', '{"type":"MESSAGE","event":"ASK_TO_UNLOCK","data":{"clientId":"a","prop":{"group":"tp"}}}']
    log = frame([(i, None, t) for i, t in enumerate(texts)], MESSAGE_LOG)
    valid, malformed = parse_messages(log)
    usable, invalid = to_requests(dispatch(valid))
    got = sort_requests(log)
    rows = lambda df: sorted(df.collect(), key=str)
    assert rows(got.where("reason IS NULL").drop("reason")) == rows(usable)
    assert rows(got.where("reason = 'invalid'").select("at.event_id")) == rows(invalid.select("at.event_id"))
    assert rows(got.where("reason = 'malformed'").select("at.event_id")) == rows(malformed.select("event_id"))
    assert {r.event_id for r in got.where("reason IS NULL").select("at.event_id").collect()} == {0, 10}
