"""State with event-time timers: agents that fall silent, approvals that run out."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from contentgate.streaming.ordered import plain

PAGES = 4096


class Heartbeats(StatefulProcessor):
    """Emits a row when an agent becomes active and when it has been silent too long.

    The silence is judged by the watermark: a timer at last heartbeat + limit. An agent that
    reports again in the very batch that would have expired it stays active. A beat without a
    time says nothing about when the agent was alive and is left out.
    """

    def __init__(self, after_ms: int):
        self.after_ms = after_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "at_ms bigint")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        newest, oldest = None, None
        for batch in rows:
            times = batch["at_ms"].dropna()
            if len(times):
                top, bottom = int(times.max()), int(times.min())
                newest = top if newest is None else max(newest, top)
                oldest = bottom if oldest is None else min(oldest, bottom)
        if newest is None:
            return
        known = int(self.last.get()[0]) if self.last.exists() else None
        if known is not None:
            self.handle.deleteTimer(known + self.after_ms)
            newest = max(newest, known)
        self.last.update((newest,))
        self.handle.registerTimer(newest + self.after_ms)
        if known is None:
            yield pd.DataFrame({"agent_id": [key[0]], "status": ["active"], "at_ms": [oldest]})

    def handleExpiredTimer(self, key: Any, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last = int(self.last.get()[0])
        self.last.clear()
        yield pd.DataFrame({"agent_id": [key[0]], "status": ["inactive"], "at_ms": [last]})

    def close(self) -> None:
        pass


def liveness_stream(beats: DataFrame, after_ms: int, delay: str = "10 minutes", clock: str = "ts") -> DataFrame:
    """Status changes per agent from heartbeats (agent_id, a timestamp)."""
    timed = beats.withWatermark(clock, delay).select("agent_id", clock, F.unix_millis(F.col(clock)).alias("at_ms"))
    return timed.groupBy("agent_id").transformWithStateInPandas(
        statefulProcessor=Heartbeats(after_ms),
        outputStructType=f"agent_id {beats.schema['agent_id'].dataType.simpleString()}, status string, at_ms bigint",
        outputMode="Append",
        timeMode="EventTime",
    )


class Expiry(StatefulProcessor):
    """Emits an approval once, when the watermark passes its end. The longest grant counts.

    The key is a page of approvals. Its state is their ids and ends in one value and a timer at the first end, so what
    Spark asks of Python per key is shared by the approvals of a page, and a micro-batch rewrites the pages it brings
    something for.
    """

    def __init__(self, id_type: str):
        self.id_type = id_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", f"ids array<{self.id_type}>, ends array<bigint>")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = self.open.get()
        ends = dict(zip(*known)) if known is not None else {}
        first = min(ends.values(), default=None)
        for batch in rows:
            batch = batch[batch["end_ms"].notna()]
            for approval, end in zip(plain(batch["approval_id"]), batch["end_ms"].astype("int64").tolist()):
                ends[approval] = max(end, ends.get(approval, end))
        if ends:
            self.keep(ends, first)
        yield from ()

    def keep(self, ends: dict, timer: int | None) -> None:
        """Write the open approvals of the page at hand; its timer goes to their first end."""
        self.open.update((list(ends), list(ends.values())))
        first = min(ends.values())
        if first != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(first)

    def handleExpiredTimer(self, key: Any, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = int(timerValues.getCurrentWatermarkInMs())
        ends = dict(zip(*self.open.get()))
        over = {approval: end for approval, end in ends.items() if end <= watermark}
        if len(over) < len(ends):
            self.keep({approval: end for approval, end in ends.items() if end > watermark}, None)
        else:
            self.open.clear()
        if over:
            yield pd.DataFrame({"approval_id": pd.Series(list(over), dtype=object), "expired_ms": pd.Series(list(over.values()), dtype="int64")})

    def close(self) -> None:
        pass


def expiry_stream(approvals: DataFrame, delay: str = "10 minutes", clock: str = "ts", pages: int = PAGES) -> DataFrame:
    """Approvals (approval_id, a timestamp, expires_in_seconds) that have run out.

    Approvals are dealt into `pages` by their ids; a stream keeps the number it began with. Those without a time or a term
    never run out and are left out.
    """
    kind = approvals.schema["approval_id"].dataType.simpleString()
    # as text: among integers pandas would turn a null, and them, into floats
    kept = kind if kind == "binary" or kind.startswith("string") else "string"
    timed = approvals.withWatermark(clock, delay).select(
        F.col("approval_id").cast(kept).alias("approval_id"), clock,
        (F.unix_millis(F.col(clock)) + F.col("expires_in_seconds") * 1000).alias("end_ms"),
        F.pmod(F.xxhash64("approval_id"), F.lit(pages)).alias("page")
    )
    expired = timed.groupBy("page").transformWithStateInPandas(
        statefulProcessor=Expiry(kept),
        outputStructType=f"approval_id {kept}, expired_ms bigint",
        outputMode="Append",
        timeMode="EventTime",
    )
    return expired.select(F.col("approval_id").cast(kind).alias("approval_id"), "expired_ms")
