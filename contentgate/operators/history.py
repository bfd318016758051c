"""Prompts with the turns sent before them, without repeating those turns in every row.

``extract.conversation_history`` writes the earlier text into each message's row, so a conversation of n turns costs
n²/2 texts up to the size limit. Here a conversation's text is written once, in segments, and a history is a reference:
the first ``history_chars`` characters of the joined segments. ``resolve_history`` writes out the text of chosen rows only,
and ``scan_turns`` needs none: no rule matches across a line feed, so running values of the messages decide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from contentgate.functions import rules as R
from contentgate.functions.text import utf16_units
from contentgate.operators.extract import SEGMENT_UNITS, TURNS_PER_SEGMENT
from contentgate.operators.gates import MAX_UNITS, oversize_reason
from contentgate.operators.verdicts import raw_from_rules, sanitize_verdicts


def _measured(df: DataFrame, content: str, *others: Column | str) -> DataFrame:
    """Messages with their lengths; a line feed separates a text from what follows, a missing one takes no place."""
    text = F.col(content).cast("string")
    place = F.when(text.isNotNull(), 1).otherwise(0)
    return df.select(
        "conv_id", "turn", *others, utf16_units(text).alias("_own"), (utf16_units(text) + place).alias("_units"),
        (F.coalesce(F.length(text), F.lit(0)) + place).cast("bigint").alias("_chars"))


def _running(messages: DataFrame, sums: tuple[str, ...], least: tuple[str, ...], ties: tuple[str, ...], turns_per_block: int) -> DataFrame:
    """``messages`` with the sums of the columns ``sums`` over the messages before each one, and the minima of ``least`` up
    to and with it, under the same names after ``_before`` and ``_least``.

    In turn order, messages of one turn by ``ties``; without a turn first. Two levels: blocks of turns and then turns, so
    no task orders a whole long conversation. A message without a conversation stands alone.
    """
    known = messages.withColumn("_alone", F.col("conv_id").isNull()).filter("not _alone").withColumn(
        "_block", F.coalesce(F.expr(f"turn div {int(turns_per_block)}"), F.lit(-(1 << 62))))
    blocks = known.groupBy("conv_id", "_block").agg(
        *[F.sum(c).alias(f"_sum{c}") for c in sums], *[F.min(c).alias(f"_min{c}") for c in least])
    earlier = W.partitionBy("conv_id").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    carry = blocks.select(
        "conv_id", "_block", *[F.coalesce(F.sum(f"_sum{c}").over(earlier), F.lit(0)).alias(f"_sum{c}") for c in sums],
        *[F.min(f"_min{c}").over(earlier).alias(f"_min{c}") for c in least])
    order = W.partitionBy("conv_id", "_block").orderBy("turn", *ties)
    before, so_far = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(W.unboundedPreceding, 0)
    together = known.join(carry, ["conv_id", "_block"]).select(
        *messages.columns,
        *[(F.col(f"_sum{c}") + F.coalesce(F.sum(c).over(before), F.lit(0))).alias(f"_before{c}") for c in sums],
        *[F.least(F.col(f"_min{c}"), F.min(c).over(so_far)).alias(f"_least{c}") for c in least])
    alone = messages.filter(F.col("conv_id").isNull()).select(
        *messages.columns, *[F.lit(0).cast("bigint").alias(f"_before{c}") for c in sums], *[F.col(c).alias(f"_least{c}") for c in least])
    return together.unionByName(alone)


def history_segments(
    df: DataFrame, content: str = "text", limit: int = SEGMENT_UNITS, turns_per_block: int = TURNS_PER_SEGMENT
) -> DataFrame:
    """The texts of each conversation, all roles, once: conv_id, segment (from 0), offset_units, offset_chars, text.

    Segments joined in order by line feeds are the conversation's texts in turn order, joined by line feeds; the offsets say
    where a segment begins in that. Segments are cut between messages and hold at most ``limit`` UTF-16 units, or one
    longer message. Conversations without text, and messages without a conversation, have no segment.
    """
    half = max(1, limit // 2)
    said = _measured(df, content, F.col(content).cast("string").alias("_text")).withColumn("_big", (F.col("_units") > half).cast("int"))
    placed = _running(said, ("_units", "_chars", "_big"), (), ("_text",), turns_per_block).filter("conv_id is not null and _text is not null")
    cells = placed.withColumn("_stretch", F.expr(f"_before_units div {half}")).groupBy("conv_id", "_stretch", "_before_big", "_big").agg(
        F.min("_before_units").alias("offset_units"), F.min("_before_chars").alias("offset_chars"),
        F.expr("listagg(_text, '\n') WITHIN GROUP (ORDER BY _before_units)").alias("text"))
    in_order = W.partitionBy("conv_id").orderBy("offset_units")
    return cells.select("conv_id", (F.row_number().over(in_order) - 1).cast("bigint").alias("segment"), "offset_units", "offset_chars", "text")


def history_references(
    df: DataFrame, limit: int = MAX_UNITS, content: str = "text", turns_per_block: int = TURNS_PER_SEGMENT
) -> DataFrame:
    """Each message with its history by reference: conv_id, turn, role, text, history_units, history_chars, oversize.

    The history is the first ``history_chars`` characters (``history_units`` UTF-16 units) of the conversation's joined
    segments. ``oversize`` as in ``conversation_history``. One row per message, no text twice.
    """
    text = F.col(content).cast("string")
    placed = _running(_measured(df, content, "role", text.alias("text")), ("_units", "_chars"), (), ("text", "role"), turns_per_block)
    units = F.greatest(F.col("_before_units") - 1, F.lit(0)).cast("bigint")
    return placed.select(
        "conv_id", "turn", "role", "text", units.alias("history_units"),
        F.greatest(F.col("_before_chars") - 1, F.lit(0)).cast("bigint").alias("history_chars"), (units + F.col("_own") > limit).alias("oversize"))


def resolve_history(references: DataFrame, segments: DataFrame, limit: int = MAX_UNITS) -> DataFrame:
    """``references`` with their ``history`` written out, NULL where the message is oversize.

    Pass the rows that are to be read, not all. A history within the limit lies in the segments that begin within the limit,
    a few per conversation; they are joined once per conversation (at most ``limit`` + 1 characters of each) and each row cuts its own prefix.
    """
    heads = segments.filter(F.col("offset_units") <= limit).groupBy(F.col("conv_id").alias("_head_conv")).agg(
        F.expr(f"listagg(left(text, {int(limit) + 1}), '\n') WITHIN GROUP (ORDER BY segment)").alias("_head"))
    history = F.left(F.coalesce("_head", F.lit("")), F.col("history_chars").cast("int"))
    return references.join(heads, F.col("conv_id") == F.col("_head_conv"), "left").select(
        *references.columns, F.when(~F.col("oversize"), history).alias("history"))


def scan_turns(
    df: DataFrame, pack: str = "core", limit: int = MAX_UNITS, content: str = "text", keep: tuple[str, ...] = ("role",),
    turns_per_block: int = TURNS_PER_SEGMENT,
) -> DataFrame:
    """One verdict per message, as if it were scanned together with all turns before it.

    Neither history nor message is moved: each message is reduced to its first matching rule and its length where it is
    read. The winner of message and history is the smallest rule up to here, their size a running sum; ``units`` above
    ``limit`` is size_limit_exceeded. A message without a conversation has no history: it may be another caller's.
    """
    ordered = R.rules_for(pack, R.PROMPT)
    reduced = _measured(df, content, *keep, R.winner(ordered, F.col(content).cast("string")).alias("_rule")).drop("_chars")
    placed = _running(reduced, ("_units",), ("_rule",), ("_units", "_rule", *keep), turns_per_block)
    units = F.greatest(F.col("_before_units") - 1, F.lit(0)) + F.col("_own")
    placed = placed.select("conv_id", "turn", *keep, units.cast("bigint").alias("units"), "_least_rule")
    scanned = raw_from_rules(placed, F.col("_least_rule"), ordered).withColumn("_large", oversize_reason(F.lit(R.PROMPT), F.col("units"), limit))
    large = F.col("_large").isNotNull()
    settled = scanned.select(
        "conv_id", "turn", *keep, "units",
        F.when(large, False).otherwise(F.col("safe")).alias("safe"),
        F.when(large, "size_limit_exceeded").otherwise(F.col("threat_type")).alias("threat_type"), "severity",
        F.when(large, 1.0).otherwise(F.col("confidence_score")).alias("confidence_score"),
        F.coalesce(F.col("_large"), F.col("reason")).alias("reason"))
    return sanitize_verdicts(settled, ("conv_id", "turn", *keep, "units"))
