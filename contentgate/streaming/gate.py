"""The guard over a stream of items, and removal of repeated requests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from contentgate.functions import rules as R
from contentgate.operators.gates import MAX_UNITS, gate
from contentgate.operators.scan import guard_items
from contentgate.streaming.streams import write_stream


def gated(items: DataFrame, dialect: str = "a", pack: str = "core", limit: int = MAX_UNITS, kinds: tuple = R.KINDS,
          profile: str = "guard") -> DataFrame:
    """Size gate, blank gate, scan and outcome. No state: the same projection as in batch."""
    return gate(guard_items(items, pack, limit, kinds=kinds, dialect=dialect, profile=profile), dialect)


def start_gate(items: DataFrame, path: str, checkpoint: str, continuous: str | None = None, **options) -> StreamingQuery:
    """Route a stream of items to the allowed rows and the quarantine of one table."""
    return write_stream(gated(items, **options), path, checkpoint, ("outcome", "content_kind"), continuous)


def first_of_requests(items: DataFrame, clock: str = "ts", delay: str = "10 minutes") -> DataFrame:
    """Drop repeats of a request id that arrive within the watermark delay. Requests without an
    id repeat nothing and all stay."""
    timed = items.withWatermark(clock, delay)
    known = timed.filter(F.col("request_id").isNotNull()).dropDuplicatesWithinWatermark(["request_id"])
    return known.unionByName(timed.filter(F.col("request_id").isNull()))
