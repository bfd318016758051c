"""Sessions by inactivity gap, and the risk that builds up over one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from contentgate.operators.keyed import floor_div, null_safe_join

SESSION_GAP_US = 30 * 60 * 1_000_000

# This engine's own weights: the chance that one finding of the severity stands for an attack.
RISK_WEIGHTS = {"critical": 0.5, "high": 0.3, "medium": 0.15, "low": 0.05}

# (pattern_id, name, category, confidence, description)
PATTERNS = (
    ("repeat_offender", "Repeated blocks", "persistence", 0.8, "Three or more blocked requests in one session"),
    ("probing", "Mixed attack types", "reconnaissance", 0.7, "Two or more threat types in one session"),
    ("replay", "Replay after block", "evasion", 0.9, "A blocked text was sent again in the same session"),
)


def gap_runs(df: DataFrame, key: str, clock: str, gap: int, inclusive: bool = False, **aggs: Column) -> DataFrame:
    """Slots of ``gap`` width per key, numbered by the run of activity they belong to.

    ``clock`` is an integer column. A new run starts after a silence longer than ``gap``
    (``inclusive``: of at least ``gap``). Two rows of one slot are less than a gap apart,
    so they always share a run: rows are reduced to one row per (key, slot) on the map
    side first, and only those go through the window. However many rows one key has, its
    window sees at most one row per slot of the covered time.

    Gives key, slot, first, last, n, run and one column per entry of ``aggs``.
    """
    slots = df.groupBy(key, floor_div(F.col(clock), gap).alias("slot")).agg(
        F.min(clock).alias("first"), F.max(clock).alias("last"), F.count(F.lit(1)).alias("n"),
        *[agg.alias(name) for name, agg in aggs.items()],
    )
    in_order = W.partitionBy(key).orderBy("slot")
    silence = F.col("first") - F.lag("last").over(in_order)
    starts = F.coalesce(silence >= gap if inclusive else silence > gap, F.lit(True))
    return slots.withColumn("_starts", starts.cast("int")).withColumn(
        "run", F.sum("_starts").over(in_order.rowsBetween(W.unboundedPreceding, 0))
    ).drop("_starts")


def sessionize(events: DataFrame, key: str, clock: str, gap: int = SESSION_GAP_US) -> DataFrame:
    """Sessions per key: number, first and last activity, count of events."""
    runs = gap_runs(events, key, clock, gap)
    return runs.groupBy(key, F.col("run").alias("session_no")).agg(
        F.min("first").alias("first_us"), F.max("last").alias("last_us"), F.sum("n").alias("n_events")
    )


def assign_sessions(events: DataFrame, key: str, clock: str, gap: int = SESSION_GAP_US) -> DataFrame:
    """Every event with the number of its session. The join is on (key, slot), so the
    events of one busy key spread over as many tasks as it has slots."""
    runs = gap_runs(events, key, clock, gap).select(key, F.col("slot").alias("_slot"), F.col("run").alias("session_no"))
    slotted = events.withColumn("_slot", floor_div(F.col(clock), gap))
    return null_safe_join(slotted, runs, [key, "_slot"]).drop("_slot")


def session_risk(verdicts: DataFrame) -> DataFrame:
    """Risk score per session: 1 - product of (1 - weight) over its unsafe verdicts.

    Counted per severity first, so the sum is the same in any order of rows and the
    partial aggregate of a session is four numbers.
    """
    unsafe = ~F.col("safe")
    counts = [
        F.count(F.when(unsafe & (F.col("severity") == name), 1)).alias(f"n_{name}") for name in RISK_WEIGHTS
    ]
    quiet = F.lit(1.0)
    for name, weight in RISK_WEIGHTS.items():
        quiet = quiet * F.pow(F.lit(1.0 - weight), F.col(f"n_{name}"))
    return (
        verdicts.groupBy("session_id")
        .agg(F.count(F.lit(1)).alias("n_requests"), F.count(F.when(unsafe, 1)).alias("n_unsafe"), *counts)
        .select("session_id", "n_requests", "n_unsafe", F.round(1.0 - quiet, 6).alias("session_risk_score"))
    )


def text_digest(text: Column) -> Column:
    """Digest of a text with case and runs of white space evened out."""
    return F.sha2(F.lower(F.regexp_replace(text, "[ \\t\\n\\r]+", " ")), 256)


def matches(n_blocked: Column, type_lo: Column, type_hi: Column, replayed: Column) -> Column:
    """The patterns that a session's numbers match, as an array of structs."""
    tests = {"repeat_offender": n_blocked >= 3, "probing": type_lo != type_hi, "replay": replayed}
    return F.array_compact(
        F.array(
            *[
                F.when(
                    tests[pid],
                    F.struct(
                        F.lit(pid).alias("pattern_id"),
                        F.lit(name).alias("pattern_name"),
                        F.lit(category).alias("category"),
                        F.lit(confidence).alias("confidence"),
                        F.lit(text).alias("description"),
                    ),
                )
                for pid, name, category, confidence, text in PATTERNS
            ]
        )
    )


def session_patterns(verdicts: DataFrame) -> DataFrame:
    """Multi-turn patterns per session, one row per match.

    Reads session_id, clock (integer order), safe, threat_type and digest. Requests are
    reduced to one row per (session, digest, threat type) before anything is gathered by
    session; a replay is a digest seen later than its first block, so no pairs are formed.
    """
    unsafe = ~F.col("safe")
    texts = verdicts.groupBy("session_id", "digest").agg(
        F.count(F.when(unsafe, 1)).alias("n_blocked"),
        F.min(F.when(unsafe, F.col("clock"))).alias("first_block"),
        F.max("clock").alias("last_seen"),
        # at most one entry per threat type of the taxonomy
        F.collect_set(F.when(unsafe, F.col("threat_type"))).alias("types"),
    )
    per_session = texts.groupBy("session_id").agg(
        F.sum("n_blocked").alias("n_blocked"),
        F.max(F.coalesce(F.col("last_seen") > F.col("first_block"), F.lit(False))).alias("replayed"),
        F.max(F.array_max("types")).alias("type_hi"),
        F.min(F.array_min("types")).alias("type_lo"),
    )
    return per_session.select("session_id", F.inline(matches(F.col("n_blocked"), F.col("type_lo"), F.col("type_hi"), F.col("replayed"))))
