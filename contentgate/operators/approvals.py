"""Human approvals: which requests one covers, and which are still open."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from contentgate.operators.keyed import floor_div

SLOT_US = 60 * 1_000_000  # a minute, then a millisecond: no window holds more than 60,000 parts of a slot
FINE_US = 1_000


def latest_by(points: DataFrame, slot_us: int = SLOT_US, fine_us: int = FINE_US) -> DataFrame:
    """The greatest `_best` of an agent up to and at each of its points in time (agent_id, _at, _best; one row each).

    A running maximum in three levels: carried over the slots of an agent, over the fine slots of a slot, then over the points of
    a fine slot. Only maxima go up a level. A busy agent is spread over its slots, and a busy slot over its fine ones: with
    times in microseconds no window but that over an agent's slots can hold more rows than a slot has parts.
    """
    timed = points.withColumns({"_slot": floor_div(F.col("_at"), slot_us), "_fine": floor_div(F.col("_at"), fine_us)})
    fines = timed.groupBy("agent_id", "_slot", "_fine").agg(F.max("_best").alias("_best"))
    slots = fines.groupBy("agent_id", "_slot").agg(F.max("_best").alias("_best"))

    def before(group: list[str], order: str) -> Column:
        return F.max("_best").over(W.partitionBy(*group).orderBy(order).rowsBetween(W.unboundedPreceding, -1))

    slots = slots.select("agent_id", "_slot", before(["agent_id"], "_slot").alias("_carry"))
    fines = fines.withColumn("_earlier", before(["agent_id", "_slot"], "_fine")).join(slots, ["agent_id", "_slot"]).select(
        "agent_id", "_fine", F.greatest("_earlier", "_carry").alias("_carry"))
    upto = W.partitionBy("agent_id", "_fine").orderBy("_at").rowsBetween(W.unboundedPreceding, 0)
    return timed.withColumn("_within", F.max("_best").over(upto)).join(fines, ["agent_id", "_fine"]).select(
        "agent_id", "_at", F.greatest("_within", "_carry").alias("_latest"))


def covering_approval(requests: DataFrame, approvals: DataFrame, slot_us: int = SLOT_US, fine_us: int = FINE_US) -> DataFrame:
    """Every request with the approval of its agent that covers it, if any.

    Requests: request_id, agent_id, at_us. Approvals: approval_id, agent_id, created_us,
    expires_in_seconds. An approval covers [created, created + seconds). Of the approvals
    granted up to a request, the one that ends last decides; it is named. A request without an agent or a time is not covered.

    No pairs are formed. Both tables are reduced on the map side to one row per agent and point in time,
    the latest end so far is a running maximum over these (`latest_by`), and requests look theirs up at (agent, time).
    """
    grants = approvals.filter("agent_id IS NOT NULL AND created_us IS NOT NULL").select(
        "agent_id",
        F.col("created_us").cast("bigint").alias("_at"),
        F.struct(
            (F.col("created_us") + F.col("expires_in_seconds") * 1_000_000).alias("end"), F.col("approval_id").alias("id")
        ).alias("_grant"),
    )
    asks = requests.select("request_id", "agent_id", F.col("at_us").cast("bigint").alias("_at"))
    nothing = F.lit(None).cast(grants.schema["_grant"].dataType)
    points = grants.unionByName(asks.filter("agent_id IS NOT NULL AND _at IS NOT NULL").select("agent_id", "_at", nothing.alias("_grant")))
    points = points.groupBy("agent_id", "_at").agg(F.max("_grant").alias("_best"))
    best = asks.join(latest_by(points, slot_us, fine_us), ["agent_id", "_at"], "left")
    covered = F.coalesce(F.col("_latest.end") > F.col("_at"), F.lit(False))
    return best.select(
        "request_id", "agent_id", covered.alias("covered"), F.when(covered, F.col("_latest.id")).alias("approval_id")
    )


def pending_approvals(verdicts: DataFrame, granted: DataFrame) -> DataFrame:
    """Approvals that verdicts ask for and nobody has granted, one row each.

    Copies of one request for approval are reduced on the map side.
    """
    info = F.col("approval_info")
    asked = (
        verdicts.groupBy(info["approval_id"].alias("approval_id"))
        .agg(F.max(F.when(info["requires_approval"], info)).alias("_info"))
        .filter(F.col("_info").isNotNull())
    )
    return asked.select("_info.*").join(granted.select("approval_id"), "approval_id", "left_anti")


def has_expired(created_us: Column, seconds: Column, now_us: Column) -> Column:
    return created_us + seconds * 1_000_000 <= now_us
