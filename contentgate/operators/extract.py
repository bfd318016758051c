"""The text a user actually sent, out of chat messages and free-form content."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from contentgate.functions import variants
from contentgate.functions.text import utf16_units
from contentgate.session import shared_dir

TURNS_PER_SEGMENT = 1024
SEGMENT_UNITS = 1 << 20


def typed_parts(content: Column) -> Column:
    """Texts of the parts of a multi-part message: type is "text" and the text is truthy."""
    texts = F.transform(
        variants.elements(content),
        lambda p: F.when(
            variants.as_string(variants.field(p, "type")) == "text",
            variants.truthy_text(variants.field(p, "text")),
        ),
    )
    return F.array_compact(texts)


def message_text(df: DataFrame, dialect: str = "a", content: str = "text") -> Column:
    """What one message contributes to the user text; NULL when it contributes nothing.

    Only the user's messages count. Dialect ``a`` drops an empty string, dialect ``b``
    keeps it as an empty line. A list contributes its text parts, joined by line feeds.
    """
    if dialect not in ("a", "b"):
        raise ValueError(f"unknown chat dialect: {dialect}")
    value = F.col(content)
    if isinstance(df.schema[content].dataType, T.VariantType):
        plain = variants.as_string(value)
        parts = typed_parts(value)
        joined = F.when(F.size(parts) > 0, F.array_join(parts, "\n"))
    else:
        plain, joined = value, F.lit(None).cast("string")
    if dialect == "a":
        plain = F.nullif(plain, F.lit(""))
    return F.when(F.col("role") == "user", F.coalesce(plain, joined))


def extract_user_text(
    df: DataFrame, dialect: str = "a", content: str = "text", limit: int = SEGMENT_UNITS, turns_per_block: int = TURNS_PER_SEGMENT
) -> DataFrame:
    """User text per conversation in segments of at most ``limit`` UTF-16 units, cut between messages.

    Gives conv_id, segment (from 0), n_segments, offset_units, user_text and n_messages, by one rule for every length:
    joining a conversation's segments in order by line feeds gives its user texts in turn order, joined by line feeds,
    and ``offset_units`` is where a segment begins in that. As no rule matches across a line feed, scanning the segments
    is scanning the whole. A message of more than half the limit is a segment of its own, whatever its size; the others
    share a segment with those that begin in the same stretch of half the limit.

    A conversation without user text has one segment, empty. A message without a conversation has a row of its own. The
    place of a message is a prefix sum in two levels, blocks of turns and then turns, so no task orders a whole long
    conversation.
    """
    half = max(1, limit // 2)
    slim = df.select(
        "conv_id", "turn", F.coalesce(F.expr(f"turn div {int(turns_per_block)}"), F.lit(-1)).alias("_block"), message_text(df, dialect, content).alias("_text"))
    # a line feed separates a message from what follows
    known = slim.filter(F.col("conv_id").isNotNull()).withColumn("_units", F.when(F.col("_text").isNotNull(), utf16_units(F.col("_text")) + 1).otherwise(0))
    known = known.withColumn("_big", (F.col("_units") > half).cast("int"))
    said = known.filter(F.col("_text").isNotNull())
    blocks = known.groupBy("conv_id", "_block").agg(F.sum("_units").alias("_units"), F.sum("_big").alias("_bigs"))
    earlier = W.partitionBy("conv_id").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    carry = blocks.select(
        "conv_id", "_block", F.coalesce(F.sum("_units").over(earlier), F.lit(0)).alias("_carry"), F.coalesce(F.sum("_bigs").over(earlier), F.lit(0)).alias("_carry_bigs"))
    within = W.partitionBy("conv_id", "_block").orderBy("turn", "_text").rowsBetween(W.unboundedPreceding, -1)
    placed = said.join(carry, ["conv_id", "_block"]).select(
        "conv_id", "turn", "_text", "_big", (F.col("_carry") + F.coalesce(F.sum("_units").over(within), F.lit(0))).alias("offset_units"),
        (F.col("_carry_bigs") + F.coalesce(F.sum("_big").over(within), F.lit(0))).alias("_bigs"))
    cells = placed.withColumn("_stretch", F.expr(f"offset_units div {half}")).groupBy("conv_id", "_stretch", "_bigs", "_big").agg(
        F.min("offset_units").alias("offset_units"), F.expr("listagg(_text, '\n') WITHIN GROUP (ORDER BY turn, _text)").alias("user_text"), F.count(F.lit(1)).alias("n_messages"))
    in_order = W.partitionBy("conv_id").orderBy("_stretch", "_bigs", "_big")
    segments = cells.select(
        "conv_id", (F.row_number().over(in_order) - 1).cast("bigint").alias("segment"), F.count(F.lit(1)).over(W.partitionBy("conv_id")).alias("n_segments"),
        F.col("offset_units").cast("bigint").alias("offset_units"), "user_text", "n_messages")
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    silent = blocks.groupBy("conv_id").agg(F.sum("_units").alias("_units")).filter("_units = 0")
    alone = slim.filter(F.col("conv_id").isNull())
    columns = lambda text, n: ["conv_id", zero.alias("segment"), one.alias("n_segments"), zero.alias("offset_units"), text.alias("user_text"), n.alias("n_messages")]
    return segments.unionByName(silent.select(columns(F.lit(""), zero))).unionByName(
        alone.select(columns(F.coalesce("_text", F.lit("")), F.col("_text").isNotNull().cast("bigint"))))


UNREADABLE = "\x00unreadable"


def _part_text(part: Column) -> Column:
    """A list element: a string stands for itself, an object for its truthy text."""
    return F.when(variants.is_kind(part, variants.STRING), F.try_variant_get(part, "$", "string")).otherwise(
        variants.truthy_text(variants.field(part, "text"))
    )


def _has_null(items: Column) -> Column:
    return F.exists(items, lambda x: variants.is_kind(x, variants.NULL))


DEPTH = 6


def _unfold(part: Column) -> Column:
    """The parts of a list element that has no text of its own, else the element."""
    inner = variants.elements(variants.field(part, "parts"))
    return F.when(_folded(part), inner).otherwise(F.array(part))


def _folded(part: Column) -> Column:
    return F.coalesce(_part_text(part).isNull() & variants.elements(variants.field(part, "parts")).isNotNull(), F.lit(False))


def _joined(items: Column) -> Column:
    return F.array_join(F.array_compact(F.transform(items, _part_text)), "\n")


def _object_text(content: Column, depth: int) -> Column:
    """Text of an object: its own, that of its list of parts, or that of the object its parts are."""
    parts = variants.field(content, "parts")
    inner = variants.elements(parts)
    deeper = _object_text(parts, depth - 1) if depth else F.lit(DEEPER)
    return F.coalesce(
        variants.truthy_text(variants.field(content, "text")),
        F.when(_has_null(inner), UNREADABLE),
        _joined(inner),
        F.when(variants.is_kind(parts, variants.OBJECT), deeper).otherwise(variants.truthy_text(parts)),
        F.lit("[object Object]"),
    )


DEEPER = "\x00deeper"


def free_text(content: Column, deep: bool = False) -> Column:
    """Text of free-form content: a string, a list, or an object with text or parts.

    Roles are ignored. NULL means the value cannot be read (JSON null, or a list that contains
    null) and the item counts as a failed scan, never as blank. Without ``deep`` a list of {role, parts}
    objects yields '' and would pass unscanned; ``deep`` reads their parts.
    An expression has a fixed depth: it reads ``DEPTH`` levels of parts, and content nested deeper is NULL here.
    ``extract_free_text`` reads a table to any depth.
    Fixed values: the texts that stand for objects and numbers without readable text.
    """
    text = _free_text(content, deep)
    return F.when(~text.isin(UNREADABLE, DEEPER), text)


def _free_text(content: Column, deep: bool) -> Column:
    """As ``free_text``, with marks for what cannot be read and for what lies deeper."""
    items = variants.elements(content)
    folded = F.lit(False)
    if deep:
        items = _unfolded(items)
        folded = F.exists(items, _folded)
    kind = variants.kind_of(content)
    return (
        F.when(kind == variants.ARRAY, F.when(folded, DEEPER).when(_has_null(items), UNREADABLE).otherwise(_joined(items)))
        .when(kind == variants.OBJECT, _object_text(content, DEPTH))
        .when(kind != variants.NULL, F.try_variant_get(content, "$", "string"))
    )


def _unfolded(items: Column) -> Column:
    for _ in range(DEPTH):
        items = F.flatten(F.transform(items, _unfold))
    return items


def extract_free_text(df: DataFrame, content: str, deep: bool = False, out: str = "text") -> DataFrame:
    """``df`` without ``content`` (free-form content as VARIANT) and with its text, however deep its parts are nested.

    A frontier of undecided rows: each round reads ``DEPTH`` levels, as ``free_text`` does, and passes on only the rows that
    go deeper, with what is left of them to read, in a table in the shared folder. Ordinary tables take one round.
    """
    keep = [c for c in df.columns if c != content]

    def saved(rows: DataFrame) -> DataFrame:
        path = shared_dir(df.sparkSession)
        rows.write.parquet(path)
        return df.sparkSession.read.schema(rows.schema).parquet(path)

    at, parts, text = F.col("_at"), F.col("_list"), F.col("_text")
    rest = df.select(*keep, F.col(content).alias("_at"), variants.elements(F.col(content)).alias("_list"))
    done: list[DataFrame] = []
    while True:
        if deep:
            rest = rest.withColumn("_list", _unfolded(parts))
        folded = F.exists(parts, _folded) if deep else F.lit(False)
        kind = variants.kind_of(at)
        read = rest.withColumn("_text", (
            F.when(parts.isNotNull(), F.when(folded, DEEPER).when(_has_null(parts), UNREADABLE).otherwise(_joined(parts)))
            .when(kind == variants.OBJECT, _object_text(at, DEPTH))
            .when(kind != variants.NULL, F.try_variant_get(at, "$", "string"))))
        if done:  # a frontier is small: each row of it is read once
            read = saved(read)
        done.append(read.filter(text.isNull() | (text != DEEPER)).select(*keep, F.when(text != UNREADABLE, text).alias(out)))
        below = at
        for _ in range(DEPTH + 1):
            below = variants.field(below, "parts")
        deeper = read.filter(text == DEEPER).select(*keep, F.when(parts.isNull(), below).alias("_at"), "_list")
        rest = deeper if len(done) > 1 else saved(deeper)
        if rest.isEmpty():
            return reduce(DataFrame.unionByName, done)


def conversation_history(
    df: DataFrame, limit: int, content: str = "text", turns_per_segment: int = TURNS_PER_SEGMENT
) -> DataFrame:
    """Each message with the turns before it, joined by line feeds.

    ``history_units`` is exact for every row. ``history`` itself is given while message and
    history together stay within ``limit`` UTF-16 units; beyond that the size gate rejects
    the request on the length alone (``history`` NULL, ``oversize`` true). So what is
    collected per conversation is bounded by the limit and not by the conversation.

    The running length is a two-level prefix sum: totals per segment of turns, then within
    the segment, so one huge conversation is spread over many tasks. A message without a
    conversation has no history: it may be another caller's.
    """
    alone = df.filter(F.col("conv_id").isNull()).select(
        "conv_id", "turn", "role", F.col(content).alias("text"), F.lit("").alias("history"), F.lit(0).cast("bigint").alias("history_units"),
        (utf16_units(F.col(content)) > limit).alias("oversize"),
    )
    alone = alone.withColumn("history", F.when(~F.col("oversize"), F.col("history")))
    slim = df.filter(F.col("conv_id").isNotNull()).select(
        "conv_id",
        F.col("conv_id").alias("_conv"),
        "turn",
        "role",
        F.col(content).alias("text"),
        F.coalesce(F.expr(f"turn div {int(turns_per_segment)}"), F.lit(-1)).alias("_segment"),
        # a line feed separates it from what follows
        (utf16_units(F.col(content)) + F.when(F.col(content).isNotNull(), 1).otherwise(0)).alias("_units"),
    )
    conversation = ["_conv"]
    segment = [*conversation, "_segment"]
    totals = slim.groupBy(*segment).agg(F.sum("_units").alias("_total"))
    earlier = W.partitionBy(*conversation).orderBy("_segment").rowsBetween(W.unboundedPreceding, -1)
    carry = totals.select(*segment, F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_carry"))
    within = W.partitionBy(*segment).orderBy("turn").rowsBetween(W.unboundedPreceding, -1)
    measured = (
        slim.join(carry, segment)
        .withColumn("_before", F.col("_carry") + F.coalesce(F.sum("_units").over(within), F.lit(0)))
        .withColumn("history_units", F.greatest(F.col("_before") - 1, F.lit(0)).cast("bigint"))
        .withColumn("oversize", F.col("history_units") + utf16_units(F.col("text")) > limit)
    )
    # Only the short prefix of a conversation is needed to build histories; it holds at
    # most limit + 1 units. Later turns carry no text into the window.
    early = F.col("_before") <= limit + 1
    running = W.partitionBy(*conversation, "_part").orderBy("turn").rowsBetween(W.unboundedPreceding, -1)
    # later turns are grouped by segment, so that no window holds a whole long conversation
    split = measured.withColumn("_part", F.when(early, F.lit(-1)).otherwise(F.col("_segment")))
    prior = F.array_join(F.collect_list(F.when(early, F.col("text"))).over(running), "\n")
    return split.withColumn("_prior", F.coalesce(prior, F.lit(""))).select(
        "conv_id", "turn", "role", "text",
        F.when(~F.col("oversize"), F.col("_prior")).alias("history"), "history_units", "oversize",
    ).union(alone)
