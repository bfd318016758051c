"""Agent liveness from heartbeats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INACTIVE_AFTER_US = 15 * 60 * 1_000_000


def agent_liveness(beats: DataFrame, now_us: Column, key: str = "agent_id", clock: str = "at_us",
                   deleted: str | None = None, after_us: int = INACTIVE_AFTER_US) -> DataFrame:
    """Last heartbeat and status per agent. A plain maximum, combined on the map side.

    ``deleted`` names a boolean column; an agent whose latest entry says so drops out.
    """
    aggs = [F.max(clock).alias("last_heartbeat_us"), F.count(F.lit(1)).alias("n_heartbeats")]
    if deleted is not None:
        aggs.append(F.max(F.struct(F.col(clock), F.col(deleted).alias("gone"))).alias("_last"))
    latest = beats.groupBy(key).agg(*aggs)
    if deleted is not None:
        latest = latest.filter(~F.col("_last.gone")).drop("_last")
    live = now_us - F.col("last_heartbeat_us") <= after_us
    return latest.withColumn("status", F.when(live, "active").otherwise("inactive"))
