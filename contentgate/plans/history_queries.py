"""Queries over histories by reference and verdicts of turns."""

from __future__ import annotations

from pyspark.sql import functions as F

from contentgate.operators import history
from contentgate.plans.registered import load, query
from contentgate.plans.scan_queries import CHAT_TEXT, CORE_REASON, CORE_TEXT, flat, verdict_sql
from contentgate.plans.text_queries import UNITS

_PRIOR = f"""SELECT conv_id, turn, role, t AS text, {UNITS.format('t')} AS u, coalesce(string_agg(t, chr(10)) OVER w, '') AS h
  FROM (SELECT *, {CHAT_TEXT} AS t FROM conversations)
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""


def _turns(spark, sf_dir):
    return load(spark, sf_dir, "conversations").withColumn("text", F.expr(CHAT_TEXT))


@query(
    "history_references",
    f"""
SELECT conv_id, turn, role, {UNITS.format('h')} AS history_units, length(h) AS history_chars, {UNITS.format('h')} + u > 102400 AS oversize
FROM ({_PRIOR})""",
)
def history_references(spark, sf_dir):
    return history.history_references(_turns(spark, sf_dir)).drop("text")


@query(
    "history_of_user_turns",
    f"""
SELECT conv_id, turn, CASE WHEN {UNITS.format('h')} + u <= 102400 THEN h END AS history, {UNITS.format('h')} + u > 102400 AS oversize
FROM ({_PRIOR}) WHERE role = 'user'""",
)
def history_of_user_turns(spark, sf_dir):
    """Only the user's messages are sent to a scan, so only their histories are written out."""
    turns = _turns(spark, sf_dir)
    asked = history.history_references(turns).filter("role = 'user'")
    return history.resolve_history(asked, history.history_segments(turns)).select("conv_id", "turn", "history", "oversize")


@query(
    "scan_turns_core",
    verdict_sql(
        f"SELECT conv_id, turn, {UNITS.format('h')} + u AS units, concat_ws(chr(10), text, h) AS content FROM ({_PRIOR})",
        "conv_id, turn, units", f"CASE WHEN units > 102400 THEN 'size_limit_exceeded' ELSE {CORE_TEXT} END", "'high'",
        f"CASE WHEN s.tt = 'size_limit_exceeded' THEN concat('Content too large (', "
        f"CAST(floor(units / 1024.0 + 0.5) AS BIGINT), 'KB > 100KB limit)') ELSE {CORE_REASON} END"),
)
def scan_turns_core(spark, sf_dir):
    return flat(history.scan_turns(_turns(spark, sf_dir)), "conv_id", "turn", "units")
