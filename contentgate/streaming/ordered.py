"""Rows of a key in time order, once the watermark says that no earlier ones are due."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

CHUNK_ROWS = 1024
OUT_ROWS = 10_000


def plain(values: pd.Series) -> list:
    """Python values; what pandas calls missing is None."""
    return [None if pd.isna(v) else v for v in values.tolist()] if values.hasnans else values.tolist()


class InOrder(StatefulProcessor):
    """Keeps rows in slots of event time and hands them on, sorted, when the watermark has passed the end of their slot.

    Pending rows are chunks in a map state: whole slots that follow each other, up to `CHUNK_ROWS` rows, or one larger slot. A
    micro-batch adds chunks and rewrites none, so a call of the state costs a chunk, not a row, and a key has one
    timer, at the end of its first pending slot. Settling reads chunks in the order of their first slots and hands on what
    lies before the next one: what a task holds of one key is a slot and the chunks that reach over its end, at most one per
    batch of rows that brought some. A row whose slot is settled already goes through the same door in the batch that brings
    it, after the rows it should have preceded; what that means is for `settle` to say.

    Subclasses name the columns of a row (`fields`: name, SQL type; the first is the time, in `per_ms` to the millisecond),
    and give `begin`, `load`, `settle`, `quiet`, `store` and `frame`. Between `load` and `store` they hold what they know of a
    key in `self`.
    """

    fields: list[tuple[str, str]]
    per_ms = 1

    def __init__(self, width_ms: int):
        self.width_ms = width_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # per chunk its first slot and its number
        self.slots = handle.getValueState("slots", "first array<bigint>, chunk array<bigint>")
        self.pending = handle.getMapState("pending", "chunk bigint", ", ".join(f"{n} array<{t}>" for n, t in self.fields))
        self.begin(handle)

    def begin(self, handle: StatefulProcessorHandle) -> None:
        """Declare the subclass's own state."""

    def load(self) -> None:
        """Read the state of the key at hand."""
        raise NotImplementedError

    def settle(self, key: Any, rows: list[tuple]) -> Iterator[tuple]:
        """Take the rows of some slots, ordered by their columns (nulls first)."""
        raise NotImplementedError

    def quiet(self, key: Any, settled: int) -> Iterator[tuple]:
        """What follows from there being no row of the key before `settled` that has not been taken."""
        raise NotImplementedError

    def store(self) -> None:
        """Write what is known of the key at hand."""
        raise NotImplementedError

    def frame(self, rows: list[tuple]) -> pd.DataFrame:
        """What `settle` and `quiet` gave, as a frame of the output's types."""
        raise NotImplementedError

    def end_ms(self, slot: int) -> int:
        return (slot + 1) * self.width_ms

    def wake(self, at: int, watermark_ms: int) -> None:
        """Call `quiet` again when all rows up to the time `at` are settled."""
        end = self.end_ms(at // (self.width_ms * self.per_ms))
        if end > watermark_ms:
            self.handle.registerTimer(end)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        firsts, chunks = (list(column) for column in self.slots.get() or ((), ()))
        known = min(firsts, default=None)
        for batch in rows:
            columns = [plain(batch[name]) for name, _ in self.fields]
            slots = batch[self.fields[0][0]].to_numpy() // (self.width_ms * self.per_ms)
            order = np.argsort(slots, kind="stable")
            ends = [*(np.flatnonzero(np.diff(slots[order])) + 1).tolist(), len(order)]
            start = 0
            for end, after in zip(ends, [*ends[1:], None]):
                if after is None or after - start > CHUNK_ROWS:
                    number = chunks[-1] + 1 if chunks else 0
                    taken = order[start:end].tolist()
                    self.pending.updateValue((number,), tuple([column[k] for k in taken] for column in columns))
                    firsts.append(int(slots[taken[0]]))
                    chunks.append(number)
                    start = end
        if firsts:
            self.slots.update((firsts, chunks))
            if known is None or min(firsts) < known:
                self.handle.registerTimer(self.end_ms(min(firsts)))
        yield from ()

    def due(self, limit: int) -> Iterator[list[tuple]]:
        """The rows of all slots before `limit`, in order, in lists of whole slots; they are pending no more."""
        listed = self.slots.get()
        if listed is None:
            return
        waiting = sorted(zip(*listed))
        read = [chunk for first, chunk in waiting if first < limit]
        if not read:
            return
        unit, held = self.width_ms * self.per_ms, []
        for k, (first, chunk) in enumerate(waiting[:len(read)]):
            held += zip(*self.pending.getValue((chunk,)))
            self.pending.removeKey((chunk,))
            upto = min(limit, waiting[k + 1][0]) if k + 1 < len(waiting) else limit
            if upto > first:
                ready = [row for row in held if row[0] < upto * unit]
                held = [row for row in held if row[0] >= upto * unit]
                yield sorted(ready, key=lambda row: [(v is not None, v) for v in row])
        left = waiting[len(read):]
        if held:  # the end of a chunk that has begun
            number = max(listed[1]) + 1
            self.pending.updateValue((number,), tuple(list(column) for column in zip(*held)))
            left.append((min(row[0] for row in held) // unit, number))
        if left:
            left.sort(key=lambda entry: entry[1])
            self.slots.update(tuple(list(column) for column in zip(*left)))
            self.handle.registerTimer(self.end_ms(min(first for first, _ in left)))
        else:
            self.slots.clear()

    def handleExpiredTimer(self, key: Any, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.watermark_ms = int(timerValues.getCurrentWatermarkInMs())
        limit, out = self.watermark_ms // self.width_ms, []
        self.load()
        for rows in self.due(limit):
            for row in self.settle(key, rows):
                out.append(row)
                if len(out) >= OUT_ROWS:
                    yield self.frame(out)
                    out = []
        out += self.quiet(key, limit * self.width_ms * self.per_ms)
        self.store()
        if out:
            yield self.frame(out)

    def close(self) -> None:
        pass
