"""Token buckets over a stream of requests: answered on arrival, or in time order behind the watermark."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from contentgate.operators.metering import DEFAULT_RPM, REFILL_MS, TOKEN
from contentgate.streaming.ordered import InOrder


class Bucket(StatefulProcessor):
    """State per key: units in the bucket and the time they were counted.

    Requests of one micro-batch are charged in time order; those without a time are not
    charged and have no answer. A request older than the state
    is charged on arrival with no refill, so units never go backwards. The state is two
    integers per key and is kept: dropping it by a timer would need late rows to be dropped.
    """

    def __init__(self, rpm: int):
        self.rpm = rpm

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.bucket = handle.getValueState("bucket", "units bigint, last bigint")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # a time and an id per request of the micro-batch; nothing else of it is held
        frame = pd.concat([batch[["ms", "request_id"]] for batch in rows]).sort_values(["ms", "request_id"], ignore_index=True)
        timeless = frame[frame["ms"].isna()]
        if len(timeless):
            yield pd.DataFrame({
                "api_key": key[0], "request_id": timeless["request_id"], "ms": pd.Series(pd.NA, timeless.index, "Int64"),
                "allowed": pd.Series(pd.NA, timeless.index, "boolean"), "remaining": pd.Series(pd.NA, timeless.index, "Int64"),
                "retry_after_ms": pd.Series(pd.NA, timeless.index, "Int64")})
        frame = frame[frame["ms"].notna()]
        if frame.empty:
            return
        ms, ids = frame["ms"].to_numpy("int64"), frame["request_id"].to_numpy()
        full = self.rpm * TOKEN
        known = self.bucket.get() if self.bucket.exists() else None
        units, last = (int(known[0]), int(known[1])) if known is not None else (full, int(ms[0]))
        # requests of one millisecond differ only in their place in line
        times, starts, counts = np.unique(ms, return_index=True, return_counts=True)
        before = np.empty(len(times), dtype="int64")
        for i, (now, n) in enumerate(zip(times.tolist(), counts.tolist())):
            units = min(full, units + max(0, now - last) * self.rpm)
            last = max(last, now)
            before[i] = units
            units -= min(n, units // TOKEN) * TOKEN
        self.bucket.update((units, last))
        place = np.arange(len(ms)) - np.repeat(starts, counts) + 1
        ahead = np.repeat(before, counts)
        granted = ahead // TOKEN
        allowed = place <= granted
        missing = TOKEN - (ahead - np.minimum(granted, np.repeat(counts, counts)) * TOKEN)
        retry = pd.Series(-(-missing // self.rpm), dtype="Int64").mask(allowed)
        yield pd.DataFrame({
            "api_key": key[0], "request_id": ids, "ms": ms, "allowed": allowed,
            "remaining": np.where(allowed, (ahead - place * TOKEN) // TOKEN, 0), "retry_after_ms": retry,
        })

    def close(self) -> None:
        pass


def token_bucket_stream(requests: DataFrame, rpm: int = DEFAULT_RPM) -> DataFrame:
    """Requests (api_key, request_id of any type, ms) with allowed, remaining and retry_after_ms."""
    kinds = {name: requests.schema[name].dataType.simpleString() for name in ("api_key", "request_id")}
    output = f"api_key {kinds['api_key']}, request_id {kinds['request_id']}, ms bigint, allowed boolean, remaining bigint, retry_after_ms bigint"
    return requests.groupBy("api_key").transformWithStateInPandas(
        statefulProcessor=Bucket(rpm), outputStructType=output, outputMode="Append", timeMode="None"
    )


ANSWER = "allowed boolean, remaining bigint, retry_after_ms bigint"


class SettledBucket(InOrder):
    """State per key: units in the bucket and the time they were counted, while it may be less than full.

    A minute after its last request a bucket is full at any rate, so then its state is removed: a key without a
    bucket has a full one. A request that comes after later ones were charged is charged without a refill.
    """

    def __init__(self, width_ms: int, id_type: str):
        super().__init__(width_ms)
        self.fields = [("ms", "bigint"), ("request_id", id_type), ("rpm", "bigint")]

    def begin(self, handle: StatefulProcessorHandle) -> None:
        self.bucket = handle.getValueState("bucket", "units bigint, last bigint")

    def load(self) -> None:
        known = self.bucket.get()
        self.level = (int(known[0]), int(known[1])) if known is not None else None
        self.was_known = known is not None

    def settle(self, key: Any, rows: list[tuple]) -> Iterator[tuple]:
        units, last = self.level or (None, None)
        for ms, group in groupby(rows, key=lambda row: row[0]):
            group = list(group)
            rate = max(rpm for _, _, rpm in group)
            units = rate * TOKEN if units is None else min(rate * TOKEN, units + max(0, ms - last) * rate)
            last = ms if last is None else max(last, ms)
            granted = units // TOKEN
            short = TOKEN - (units - min(granted, len(group)) * TOKEN)
            for place, (_, request, rpm) in enumerate(group, 1):
                yes = place <= granted
                yield key[0], request, ms, rpm, yes, (units - place * TOKEN) // TOKEN if yes else 0, None if yes else -(-short // rpm)
            units -= min(granted, len(group)) * TOKEN
            self.level = (units, last)

    def quiet(self, key: Any, settled: int) -> Iterator[tuple]:
        if self.level is not None:
            last = self.level[1]
            if last + REFILL_MS < settled:
                self.level = None
            else:
                self.wake(last + REFILL_MS, self.watermark_ms)
        yield from ()

    def store(self) -> None:
        if self.level is not None:
            self.bucket.update(self.level)
        elif self.was_known:
            self.bucket.clear()

    def frame(self, rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=["api_key", "request_id", "ms", "rpm", "allowed", "remaining", "retry_after_ms"], dtype=object)
        return out.astype({"ms": "int64", "rpm": "int64", "allowed": "bool", "remaining": "int64", "retry_after_ms": "Int64"})


def settled_bucket_stream(requests: DataFrame, rpm: int | Column = DEFAULT_RPM, delay: str = "1 minute", width_ms: int = REFILL_MS) -> DataFrame:
    """Requests (api_key, request_id, ms) with rpm, allowed, remaining and retry_after_ms, as the batch replay gives them.

    Answers are final: a request is charged in the order of (ms, request_id) once the watermark, `delay` behind the newest
    ms, has passed the end of its slot of `width_ms`. So the result is that of `token_bucket` however the rows
    are dealt to micro-batches, as long as none is later than `delay`; later ones are charged on arrival, without refill,
    and no row is lost. The rate is a column: NULL is no limit, 0 or less bars the key. Both, and requests without a time, are
    answered at once and need no state.
    """
    kinds = {name: requests.schema[name].dataType.simpleString() for name in ("api_key", "request_id")}
    rate = F.lit(rpm) if isinstance(rpm, int) else rpm
    rows = requests.select("api_key", "request_id", F.col("ms").cast("bigint").alias("ms"), rate.cast("bigint").alias("rpm"))
    charged = F.col("ms").isNotNull() & F.coalesce(F.col("rpm") > 0, F.lit(False))
    limited = rows.filter(charged).withColumn("ts", F.timestamp_millis("ms")).withWatermark("ts", delay)
    # without the event time among the columns Spark advances the watermark but drops no late row
    settled = limited.select("api_key", "request_id", "ms", "rpm").groupBy("api_key").transformWithStateInPandas(
        statefulProcessor=SettledBucket(width_ms, kinds["request_id"]),
        outputStructType=f"api_key {kinds['api_key']}, request_id {kinds['request_id']}, ms bigint, rpm bigint, {ANSWER}",
        outputMode="Append", timeMode="EventTime")
    timed = F.col("ms").isNotNull()
    others = rows.filter(~charged).select(
        "*", F.when(timed, F.col("rpm").isNull()).alias("allowed"),
        F.when(timed & F.col("rpm").isNotNull(), F.lit(0)).cast("bigint").alias("remaining"),
        F.lit(None).cast("bigint").alias("retry_after_ms"))
    return settled.unionByName(others)
