"""The ordered streams' state, held by a store in memory that counts what is asked of it."""

import random

import pandas as pd
import pytest

from contentgate.streaming import ordered, risk, timers


class Store:
    """One key's state and timers."""

    def __init__(self):
        self.calls, self.timers, self.maps = 0, set(), {}

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.calls += 1
        self.timers.remove(at)

    def getMapState(self, name, *schemas):
        return self.maps.setdefault(name, State(self))

    getValueState = getMapState


class State(dict):
    def __init__(self, store):
        super().__init__()
        self.store = store

    def _call(self, result=None):
        self.store.calls += 1
        return result

    def get(self):
        return self._call(dict.get(self, None))

    def exists(self):
        return self._call(None in self)

    def update(self, value):
        self._call(self.__setitem__(None, value))

    def updateValue(self, key, value):
        self._call(self.__setitem__(key, value))

    def getValue(self, key):
        return self._call(self[key])

    def removeKey(self, key):
        self._call(self.pop(key))

    def containsKey(self, key):
        return self._call(key in self)

    def keys(self):
        return self._call(list(dict.keys(self)))

    def clear(self):
        self._call(dict.clear(self))


class Now:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def follow(batches, gap_s=60, width_ms=20_000):
    """Sessions and calls of the state for micro-batches of one key: (watermark in ms, rows)."""
    store, out = Store(), []
    processor = risk.OpenSession(width_ms, gap_s * 1_000_000)
    processor.init(store)
    for watermark, rows in batches:
        frames = [pd.DataFrame(rows[k:k + 50], columns=["us", "digest", "unsafe", "threat_type"]) for k in range(0, len(rows), 50)]
        out += [*processor.handleInputRows(("k",), iter(frames), Now(watermark))] if rows else []
        while due := [t for t in store.timers if t <= watermark]:
            store.timers.remove(min(due))
            out += processor.handleExpiredTimer(("k",), Now(watermark), None)
    return sorted(map(tuple, pd.concat(out)[risk.SESSION].astype(object).where(lambda v: v.notna(), None).values.tolist())), store


def turns(n, seed=5, span=9_000):
    rng = random.Random(seed)
    found = []
    for _ in range(n):
        unsafe = rng.random() < 0.4
        found.append((rng.randrange(span) * 1_000_000, rng.choice("=abcdef"), unsafe, rng.choice(["x", "y", None]) if unsafe else None))
    return found


def test_calls_of_the_state_follow_the_chunks_not_the_rows():
    rows = [(40 * k * 1_000_000, "a", False, None) for k in range(500)]  # a slot each, and one session
    sessions, store = follow([(0, rows), (10**9, [])])
    assert [s[:3] for s in sessions] == [(0, 499 * 40_000_000, 0)]
    assert store.calls < 60  # eleven a row, and a timer a slot, when each slot had its own chunk and timer


@pytest.mark.parametrize("chunk_rows, held", [(1, 1), (3, 2), (64, 100_000)])
def test_chunks_of_any_size_give_the_same_sessions(monkeypatch, chunk_rows, held):
    rows = turns(600) + [(4_000_000_000, d, True, "x") for d in "ab"] * 40
    want, _ = follow([(0, rows), (10**9, [])])
    assert len(want) > 10 and any(s[-1] for s in want) and not all(s[-1] for s in want)
    monkeypatch.setattr(ordered, "CHUNK_ROWS", chunk_rows)
    monkeypatch.setattr(risk, "HELD_TEXTS", held)
    dealt = sorted(rows, key=lambda r: (r[0] + random.Random(str(r)).randrange(300_000_000), str(r)))
    parts = [dealt[k:k + 90] for k in range(0, len(dealt), 90)]
    # rows of later batches are at most 300 s behind
    marks = [max(0, max(r[0] for part in parts[:k + 1] for r in part) // 1000 - 300_000) for k in range(len(parts))]
    got, store = follow([*zip([0, *marks], parts), (10**9, [])])
    assert got == want
    assert not any(dict.__len__(state) for state in store.maps.values())


def test_calls_of_the_state_follow_the_pages_not_the_approvals():
    store, processor = Store(), timers.Expiry("string")
    processor.init(store)
    for start in (0, 50):  # half of the second batch are longer grants of the first
        ids = [f"a{k}" for k in range(start, start + 100)]
        frame = pd.DataFrame({"approval_id": ids, "end_ms": [1_000 + start + k for k in range(100)]})
        assert not [*processor.handleInputRows((0,), iter([frame[:70], frame[70:]]), Now(0))]
    out = []
    for watermark in (1_010, 1_100, 10_000):
        while due := [t for t in store.timers if t <= watermark]:
            store.timers.remove(min(due))
            out += processor.handleExpiredTimer((0,), Now(watermark), None)
    got = pd.concat(out)
    assert dict(zip(got["approval_id"], got["expired_ms"])) == {f"a{k}": 1_000 + k for k in range(150)} and len(got) == 150
    assert [len(frame) for frame in out] == [11, 90, 49]
    assert store.calls < 20 and not dict.__len__(store.maps["open"])  # four or five an approval when each had a state of its own
