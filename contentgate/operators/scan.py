"""Scans: a table of content items in, one verdict per item out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contentgate.functions import rules as R
from contentgate.functions.text import is_blank, utf16_units
from contentgate.operators.gates import MAX_UNITS, NOT_SCANNED, blank_reason, oversize_reason
from contentgate.operators.extract import message_text
from contentgate.operators.verdicts import pick_verdicts, raw_from_rules, sanitize_verdicts


def _rule_table(pack: str, allow_destructive: bool) -> dict[str, list[R.Rule]]:
    return {kind: R.rules_for(pack, kind, allow_destructive) for kind in R.KINDS}


def _with_subjects(items: DataFrame, pack: str) -> tuple[DataFrame, R.Subject, R.Subject]:
    """Derive once per row what many rules of a pack read. The core pack reads little: its
    few expressions stay where they are used."""
    if pack == "core":
        return items, R.subject(F.col("content")), R.subject(F.col("body"))
    subjects = {name: R.subject(F.col(name)) for name in ("content", "body")}
    wide = items.select(
        "*",
        *[s.lower.alias(f"_{name}_lower") for name, s in subjects.items()],
        *[s.digits.alias(f"_{name}_digits") for name, s in subjects.items()],
    )
    content, body = [
        R.Subject(F.col(name), F.col(f"_{name}_lower"), F.col(f"_{name}_digits")) for name in subjects
    ]
    return wide, content, body


def scan_raw(
    items: DataFrame,
    pack: str = "core",
    allow_destructive: bool = False,
    kinds: tuple = R.KINDS,
    skip: Column | None = None,
) -> DataFrame:
    """Items with the raw result of the rules of their kind: safe, threat_type,
    confidence_score, reason. A projection: no shuffle, and no rule runs after the winner.

    Naming the ``kinds`` that occur keeps the expression small. An item of another kind, or of
    none, is not decided: ``usable`` is false and every verdict column of it becomes NULL.
    Rows for which ``skip`` holds are not scanned and come out safe.
    """
    table = _rule_table(pack, allow_destructive)
    wide, content, body = _with_subjects(items, pack)
    ordered: list[R.Rule] = []
    position = None
    for kind in kinds:
        # positions are offset so that one list holds the rules of all kinds
        local = R.winner(table[kind], content, body) + len(ordered)
        is_kind = F.col("content_kind") == kind
        position = F.when(is_kind, local) if position is None else position.when(is_kind, local)
        ordered.extend(table[kind])
    if skip is not None:
        position = F.when(~skip, position)
    decided = F.coalesce(F.col("content_kind").isin(*kinds), F.lit(False))
    placed = wide.select(*items.columns, position.alias("_position"), (decided if skip is None else decided | skip).alias("_decided"))
    return raw_from_rules(placed, F.col("_position"), ordered).withColumnRenamed("_decided", "usable").drop("_position")


def scan(
    items: DataFrame,
    pack: str = "core",
    allow_destructive: bool = False,
    keep: tuple[str, ...] = ("request_id", "content_kind"),
    kinds: tuple = R.KINDS,
    scorer: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """One public verdict per item.

    ``scorer`` replaces the rule pack: any function from items to findings (request_id,
    rule_id, rule_ord, raw_threat_type, confidence_score). Items without findings are safe; an
    item without an id cannot be matched to findings and stays undecided.
    """
    if scorer is None:
        return sanitize_verdicts(scan_raw(items, pack, allow_destructive, kinds), keep)
    picked = pick_verdicts(scorer(items)).select(
        "request_id", F.col("threat_type").alias("_type"), F.col("severity").alias("_sev"), "confidence"
    )
    joined = items.select(*keep).join(picked, "request_id", "left")
    typed = joined.select(
        *keep,
        F.col("request_id").isNotNull().alias("usable"),
        F.col("_type").isNull().alias("safe"),
        F.col("_type").alias("threat_type"),
        F.col("_sev").alias("severity"),
        F.lit(None).cast("double").alias("confidence_score"),
        F.lit(None).cast("string").alias("reason"),
        F.col("confidence").alias("_level"),
    )
    level = typed.columns[-1]
    return sanitize_verdicts(typed, (*keep, level)).withColumn(
        "confidence", F.when(~F.col("safe"), F.col(level))
    ).drop(level)


def findings(items: DataFrame, pack: str = "extended", allow_destructive: bool = False, kinds: tuple = R.KINDS) -> DataFrame:
    """Every matching rule of every item, one row each."""
    table = _rule_table(pack, allow_destructive)
    wide, content, body = _with_subjects(items, pack)
    found = None
    for kind in kinds:
        is_kind = F.col("content_kind") == kind
        local = R.hits(table[kind], content, body)
        found = F.when(is_kind, local) if found is None else found.when(is_kind, local)
    return wide.select("request_id", "content_kind", F.explode(found).alias("f")).select(
        "request_id", "content_kind", "f.*"
    )


def card_field_findings(cards: DataFrame, pack: str = "core") -> DataFrame:
    """Which field of an agent card matched: the rules run on every top-level value too."""
    fields = cards.select(
        "request_id",
        F.explode(F.from_json("content", "map<string,string>")).alias("field", "content"),
        F.lit(R.CARD).alias("content_kind"),
        F.lit(None).cast("string").alias("body"),
    )
    scanned = scan_raw(fields, pack, kinds=(R.CARD,))
    return scanned.filter(~F.col("safe")).select("request_id", "field", "threat_type", "confidence_score")


def scan_chat(
    messages: DataFrame, dialect: str = "a", pack: str = "core", content: str = "text", limit: int | None = None
) -> DataFrame:
    """One verdict per conversation, as if its user texts were joined and scanned as one.

    The joined text is never built. No rule matches across a line feed, so the first
    matching rule of the joined text is the smallest rule position over the messages; its
    length is the sum of the lengths plus the separators; it is blank when every message
    is. All three combine on the map side, so a conversation of any length costs one small
    row per task. ``limit`` adds the size gate. Messages without a conversation are no
    conversation: each has a verdict of its own.
    """
    ordered = R.rules_for(pack, R.PROMPT)
    text = message_text(messages, dialect, content)
    per_message = messages.select("conv_id", text.alias("_text")).select(
        "conv_id",
        R.winner(ordered, F.col("_text")).alias("_position"),
        F.when(F.col("_text").isNotNull(), utf16_units(F.col("_text"))).alias("_units"),
        is_blank(F.col("_text")).alias("_blank"),
    )
    merged = per_message.filter(F.col("conv_id").isNotNull()).groupBy("conv_id").agg(
        F.min("_position").alias("_position"),
        F.count("_units").alias("n_messages"),
        F.coalesce(F.sum("_units"), F.lit(0)).alias("_units"),
        F.coalesce(F.bool_and("_blank"), F.lit(True)).alias("_blank"),
    ).union(per_message.filter(F.col("conv_id").isNull()).select(
        "conv_id", "_position", F.col("_units").isNotNull().cast("bigint"), F.coalesce("_units", F.lit(0)), F.coalesce("_blank", F.lit(True)),
    ))
    units = F.col("_units") + F.greatest(F.col("n_messages") - 1, F.lit(0))
    merged = merged.withColumn("units", units)
    scanned = raw_from_rules(merged, F.col("_position"), ordered)
    too_large = F.lit(None).cast("string") if limit is None else oversize_reason(F.lit(R.PROMPT), F.col("units"), limit)
    blank = blank_reason(F.when(F.col("_blank"), "").otherwise("x"), dialect)
    stopped = scanned.withColumn("_blank_reason", blank).withColumn("_size_reason", too_large)
    early = stopped.select(
        "conv_id",
        "n_messages",
        "units",
        F.when(F.col("_blank_reason").isNotNull(), True)
        .when(F.col("_size_reason").isNotNull(), False)
        .otherwise(F.col("safe"))
        .alias("safe"),
        F.when(F.col("_size_reason").isNotNull(), "size_limit_exceeded").otherwise(F.col("threat_type")).alias(
            "threat_type"
        ),
        "severity",
        F.when(F.col("_size_reason").isNotNull(), 1.0).otherwise(F.col("confidence_score")).alias("confidence_score"),
        F.coalesce(F.col("_blank_reason"), F.col("_size_reason"), F.col("reason")).alias("reason"),
    )
    return sanitize_verdicts(early, ("conv_id", "n_messages", "units"))


def guard_items(
    items: DataFrame,
    pack: str = "core",
    limit: int = MAX_UNITS,
    allow_destructive: bool = False,
    kinds: tuple = R.KINDS,
    dialect: str = "a",
    profile: str = "guard",
) -> DataFrame:
    """Gates and scan in one pass over the items; what a gate settles is not scanned.

    Profile ``guard`` is a wrapped chat client: its prompts pass the blank gate (with the
    reason of ``dialect``) and have no size limit; the other kinds are limited in size.
    Profile ``client`` is the low-level client: every kind is limited, nothing is blank.

    Every input column passes through; the verdict columns of ``sanitize_verdicts`` are added.
    Items of a kind that is not scanned come out with ``safe`` NULL and a reason, which
    ``gate`` turns into the outcome scan_error.
    """
    if profile not in ("guard", "client"):
        raise ValueError(f"unknown profile: {profile}")
    # a text never has more UTF-16 units than UTF-8 bytes, and those are known without decoding
    octets = F.octet_length(F.coalesce("content", F.lit(""))) + F.octet_length(F.coalesce("body", F.lit("")))
    exact = utf16_units(F.col("content")) + utf16_units(F.col("body"))
    sized = items.withColumn("_units", F.when(octets > limit, exact))
    large = oversize_reason(F.col("content_kind"), F.col("_units"), limit)
    chat = F.coalesce(F.col("content_kind") == R.PROMPT, F.lit(False))
    staged = sized.select(
        *items.columns,
        (large if profile == "client" else F.when(~chat, large)).alias("_large"),
        (F.when(chat, blank_reason(F.col("content"), dialect)) if profile == "guard" else F.lit(None).cast("string")).alias("_blank"),
    )
    early = F.col("_large").isNotNull() | F.col("_blank").isNotNull()
    scanned = scan_raw(staged, pack, allow_destructive, kinds, skip=early)
    large = F.col("_large").isNotNull()
    resolved = scanned.select(
        *items.columns,
        "usable",
        F.when(large, False).otherwise(F.col("safe")).alias("safe"),
        F.when(large, "size_limit_exceeded").otherwise(F.col("threat_type")).alias("threat_type"),
        "severity",
        F.when(large, 1.0).otherwise(F.col("confidence_score")).alias("confidence_score"),
        F.coalesce(F.col("_large"), F.col("_blank"), F.col("reason")).alias("reason"),
    )
    done = sanitize_verdicts(resolved, tuple(items.columns))
    return done.withColumn("reason", F.when(F.col("safe").isNull(), F.lit(NOT_SCANNED)).otherwise(F.col("reason")))
