"""Keyed state is asked for each entry once a batch, and an update is one fact however many wait for its row."""

import random
from datetime import datetime, timedelta

import pandas as pd

from tidemark.schemas import GROUPS
from tidemark.streaming import keyed_locks as K

START = datetime(2024, 1, 1)


class State(dict):
    """A map state, or with the key ``()`` a value state, that counts what it is asked."""

    calls = 0

    def _counted(self, value):
        self.calls += 1
        return value

    def getValue(self, key):
        return self._counted(self.get(key))

    def updateValue(self, key, value):
        self._counted(self.__setitem__(key, value))

    def removeKey(self, key):
        self._counted(self.pop(key, None))

    def iterator(self):
        return iter(self._counted(list(self.items())))

    def exists(self):
        return () in self

    def update(self, value):
        self[()] = value


class Handle(dict):
    def getMapState(self, name, *_):
        return self.setdefault(name, State())

    def getValueState(self, name, *_):
        state = self.setdefault(name, State())
        state.get = lambda: state[()]
        return state


def run(processor, rows, names):
    frame = pd.DataFrame([dict.fromkeys(names) | r for r in rows], columns=names)
    frame["ts"] = pd.to_datetime(frame["ts"])
    return [r for f in processor.handleInputRows(None, iter([frame]), None) for r in f.to_dict("records")]


def step(i, kind, client, **more):
    return {"ts": START + timedelta(seconds=i), "event_id": i, "kind": kind, "client": client, "grp": "pod", "row_id": "1", "pos": 0} | more


def test_a_row_hands_on_an_update_once_and_asks_for_little():
    handle, queue = Handle(), K.RowQueue()
    queue.init(handle)
    names = K._names(K.STEP)
    entered = run(queue, [step(i, K.REGISTER, f"c{i}", entered=True) for i in range(300)], names)
    assert [f["queue_position"] for f in entered if f["kind"] == "enter"] == list(range(300))
    handle["queue"].calls = handle["places"].calls = 0
    facts = run(queue, [step(400, K.UPDATE, "c7", entered=False), step(401, K.LEAVE, "c0", entered=False), step(402, K.UPDATE, "c8", entered=False)], names)
    assert [(f["kind"], f["client"], f["seq"]) for f in facts] == [("update", "c7", 301), ("left", "c0", 302), ("granted", "c1", 302), ("update", "c8", 303)]
    assert handle["queue"].calls + handle["places"].calls <= 6
    # If a batch is about as many clients as the queue has, the queue is read in one go.
    handle["queue"].calls = handle["places"].calls = 0
    facts = run(queue, [step(500 + i, K.LEAVE, f"c{i}", entered=False) for i in range(300)], names)
    assert sum(f["kind"] == "left" for f in facts) == 299 and handle["places"].calls == 299 and handle["queue"].calls == 300
    assert not handle["queue"] and not handle["places"]


def test_rows_of_a_client_are_those_it_asked_for(monkeypatch):
    monkeypatch.setattr(K, "SLOT", 2)
    rng, handle, clients = random.Random(3), Handle(), K.ClientRows()
    clients.init(handle)
    names, held, low = K._names(K.ASKED), {}, 0
    for high in (40, 41, 60, 200):
        asked, expected = [], []
        for i in range(low, high):
            client, g, row = rng.choice("ab"), rng.choice(GROUPS[:2]), str(rng.randrange(9))
            if rng.random() < 0.85:
                rows = held.setdefault((client, g), set())
                asked.append(step(i, K.REGISTER, client, grp=g, row_id=row))
                expected.append((i, K.REGISTER, client, g, row, row not in rows))
                rows.add(row)
            else:
                grp = rng.choice([g, ""])
                asked.append(step(i, K.LEAVE, client, grp=grp, row_id=""))
                for each in (grp,) if grp else GROUPS:
                    expected += [(i, K.LEAVE, client, each, row, False) for row in held.pop((client, each), ())]
        got = run(clients, rng.sample(asked, len(asked)), names)
        assert sorted((r["event_id"], r["kind"], r["client"], r["grp"], r["row_id"], r["entered"]) for r in got) == sorted(expected)
        low = high
    late = run(clients, [step(1, K.REGISTER, "a", grp=GROUPS[0]), step(2, K.UPDATE, "a")], names)
    assert sorted((r["kind"], r["entered"]) for r in late) == [(K.LATE, False), (K.UPDATE, False)]
