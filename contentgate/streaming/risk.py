"""Session risk and multi-turn patterns over a stream of verdicts."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessorHandle

from contentgate.operators.sessions import RISK_WEIGHTS, SESSION_GAP_US, matches
from contentgate.streaming.ordered import InOrder


def session_risk_stream(verdicts: DataFrame, key: str = "user_id", clock: str = "ts", gap: str = "30 minutes",
                        delay: str = "10 minutes") -> DataFrame:
    """Risk per session of activity, emitted once the watermark has passed its end.

    State per open session is one counter per severity. Two events exactly a gap apart
    share a session, as in the batch form.
    """
    unsafe = ~F.col("safe")
    counts = [F.count(F.when(unsafe & (F.col("severity") == name), 1)).alias(f"n_{name}") for name in RISK_WEIGHTS]
    quiet = F.lit(1.0)
    for name, weight in RISK_WEIGHTS.items():
        quiet = quiet * F.pow(F.lit(1.0 - weight), F.col(f"n_{name}"))
    grouped = verdicts.withWatermark(clock, delay).groupBy(key, F.session_window(clock, gap).alias("w")).agg(
        F.count(F.lit(1)).alias("n_requests"), *counts
    )
    return grouped.select(
        key,
        F.unix_micros("w.start").alias("first_us"),
        "n_requests",
        F.round(1.0 - quiet, 6).alias("session_risk_score"),
    )


SESSION = ["first_us", "last_us", "n_blocked", "type_lo", "type_hi", "replayed"]
HELD_TEXTS = 100_000


class OpenSession(InOrder):
    """State per key: the numbers of its open session, and when each blocked text was first blocked in it.

    Texts are kept as digests, and only those that were blocked, in a map state that is cleared with the session. A row
    that comes after later ones were taken joins the session then open, or begins one.
    """

    fields = [("us", "bigint"), ("digest", "string"), ("unsafe", "boolean"), ("threat_type", "string")]
    per_ms = 1000

    def __init__(self, width_ms: int, gap_us: int):
        super().__init__(width_ms)
        self.gap_us = gap_us

    def begin(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getValueState("open", "first_us bigint, last_us bigint, n_blocked bigint, type_lo string, type_hi string, replayed boolean")
        self.blocks = handle.getMapState("blocks", "digest string", "us bigint")

    def load(self) -> None:
        self.session = self.open.get()
        # blocked texts of the open session: those looked up or changed since, whether the map state holds any, and whether it is to be cleared
        self.begun, self.changed, self.kept, self.stale, self.was_open = {}, set(), self.session is not None, False, self.session is not None

    def first_block(self, digest: str) -> int | None:
        if self.kept and digest not in self.begun:
            self.begun[digest] = int(self.blocks.getValue((digest,))[0]) if self.blocks.containsKey((digest,)) else None
        return self.begun.get(digest)

    def spill(self) -> None:
        if self.stale:
            self.blocks.clear()
            self.stale = False
        for digest in self.changed:
            self.blocks.updateValue((digest,), (self.begun[digest],))
        self.kept = self.kept or bool(self.changed)
        self.begun, self.changed = {}, set()

    def finished(self, key: Any, session: tuple) -> tuple:
        self.stale = self.stale or self.kept
        self.session, self.begun, self.changed, self.kept = None, {}, set(), False
        return (key[0], *session)

    def settle(self, key: Any, rows: list[tuple]) -> Iterator[tuple]:
        for us, digest, unsafe, threat in rows:
            if self.session is not None and us - self.session[1] > self.gap_us:
                yield self.finished(key, self.session)
            first, last, blocked, lo, hi, replayed = self.session or (us, us, 0, None, None, False)
            begun = self.first_block(digest)
            if unsafe:
                blocked += 1
                if threat is not None:
                    lo, hi = min(threat, lo or threat), max(threat, hi or threat)
                if begun is None or us < begun:
                    self.begun[digest] = us
                    self.changed.add(digest)
            # a text is replayed if it is there later than its first block
            self.session = (min(first, us), max(last, us), blocked, lo, hi, replayed or (begun is not None and us > begun))
            if len(self.begun) >= HELD_TEXTS:
                self.spill()

    def quiet(self, key: Any, settled: int) -> Iterator[tuple]:
        if self.session is not None:
            if self.session[1] + self.gap_us < settled:
                yield self.finished(key, self.session)
            else:
                self.wake(self.session[1] + self.gap_us, self.watermark_ms)

    def store(self) -> None:
        self.spill()
        if self.session is not None:
            self.open.update(self.session)
        elif self.was_open:
            self.open.clear()

    def frame(self, rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=["key", *SESSION], dtype=object)
        return out.astype({"first_us": "int64", "last_us": "int64", "n_blocked": "int64", "replayed": "bool"})


def session_patterns_stream(verdicts: DataFrame, key: str = "user_id", clock: str = "ts", gap_us: int = SESSION_GAP_US,
                            delay: str = "10 minutes", width_ms: int = 300_000) -> DataFrame:
    """What `session_patterns` finds, per session of activity, once the watermark says that it is over.

    Reads the key, a timestamp, safe, threat_type and digest; gives the key, first_us and the columns of a pattern. Rows are taken
    in time order, so a replay is judged as in the batch form however rows arrive within `delay`. Two events exactly a gap apart
    share a session. Rows without a time belong to no session; a null digest is a text like any other; null `safe` is not unsafe.
    """
    kind = verdicts.schema[key].dataType.simpleString()
    timed = verdicts.filter(F.col(clock).isNotNull()).withWatermark(clock, delay)
    # without the event time among the columns Spark advances the watermark but drops no late row
    rows = timed.select(
        F.col(key).alias("key"), F.unix_micros(clock).alias("us"), F.coalesce(F.concat(F.lit("="), "digest"), F.lit("")).alias("digest"),
        F.coalesce(~F.col("safe"), F.lit(False)).alias("unsafe"), "threat_type")
    sessions = rows.groupBy("key").transformWithStateInPandas(
        statefulProcessor=OpenSession(width_ms, gap_us),
        outputStructType=f"key {kind}, first_us bigint, last_us bigint, n_blocked bigint, type_lo string, type_hi string, replayed boolean",
        outputMode="Append", timeMode="EventTime")
    return sessions.select(
        F.col("key").alias(key), "first_us", F.inline(matches(F.col("n_blocked"), F.col("type_lo"), F.col("type_hi"), F.col("replayed"))))
