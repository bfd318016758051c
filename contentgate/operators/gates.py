"""Gates a request passes on its way: blank, size, scan failure, block or allow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contentgate.functions.rules import A2A, CARD, FILE_CONTENT, FILE_PATH, PROMPT, SQL
from contentgate.functions.text import is_blank, non_empty, utf16_units

# --- fixed values: limits and messages --------------------------------------
MAX_UNITS = 100 * 1024
NO_USER_CONTENT = "No user content to scan"
NO_TEXT_CONTENT = "No text content to scan"
SIZE_NOUNS = {
    PROMPT: "Content",
    SQL: "SQL query",
    FILE_PATH: "File content",
    FILE_CONTENT: "File content",
    A2A: "Message",
    CARD: "Agent card",
}
ERROR_NOUNS = {
    PROMPT: "Scan",
    SQL: "SQL scan",
    FILE_PATH: "File scan",
    FILE_CONTENT: "File scan",
    A2A: "A2A message scan",
    CARD: "Agent card scan",
}
TIMEOUT_OPEN = "Scan timeout, failing open"
TIMEOUT_CLOSED = "Scan request timed out and fail_mode is 'closed'"
DEFAULT_THREAT = "Security threat detected"
DEFAULT_BLOCK = "Request blocked"
# --- end of fixed values ----------------------------------------------------

NOT_SCANNED = "Content kind was not scanned"
VIOLATIONS_TYPE = "array<struct<type:string,description:string>>"


def by_kind(kind: Column, values: dict[str, str]) -> Column:
    chain = None
    for name, value in values.items():
        chain = F.when(kind == name, F.lit(value)) if chain is None else chain.when(kind == name, F.lit(value))
    return chain


def blank_reason(text: Column, dialect: str = "a") -> Column:
    """The reason of the early safe verdict for text with nothing to scan, else NULL."""
    return F.when(is_blank(F.coalesce(text, F.lit(""))), NO_TEXT_CONTENT if dialect == "c" else NO_USER_CONTENT)


def oversize_reason(kind: Column, units: Column, limit: int = MAX_UNITS) -> Column:
    """The reason of the early unsafe verdict for an oversized item, else NULL."""
    limit_kb = f"{limit / 1024:g}"
    size_kb = F.round(units / 1024).cast("bigint").cast("string")
    return F.when(
        units > limit,
        F.concat(by_kind(kind, SIZE_NOUNS), F.lit(" too large ("), size_kb, F.lit(f"KB > {limit_kb}KB limit)")),
    )


def size_gate(items: DataFrame, limit: int = MAX_UNITS) -> DataFrame:
    """Mark items whose content and body together exceed ``limit`` UTF-16 units.

    Adds ``units, too_large`` and, for oversized items only, the verdict the caller gets:
    reason, violations and a score of 1.0. Runs before metering: a rejected item costs no token.
    """
    limit_kb = f"{limit / 1024:g}"
    measured = items.withColumn("units", utf16_units(F.col("content")) + utf16_units(F.col("body")))
    too_large = F.col("units") > limit
    what = F.when(F.col("content_kind") == SQL, "Query").otherwise("Content")
    violation = F.struct(
        F.lit("size_limit").alias("type"),
        F.concat(what, F.lit(f" exceeds maximum size of {limit_kb}KB")).alias("description"),
    )
    return measured.select(
        "*",
        too_large.alias("too_large"),
        oversize_reason(F.col("content_kind"), F.col("units"), limit).alias("size_reason"),
        F.when(too_large, F.lit(1.0)).alias("size_score"),
        F.when(too_large, F.array(violation)).cast(VIOLATIONS_TYPE).alias("violations"),
    )


def resolve_fail_mode(df: DataFrame, mode: str = "closed", profile: str = "guard") -> DataFrame:
    """Turn failed scans into outcomes.

    Reads ``content_kind, usable, status, error, safe, reason``: ``usable`` is false or NULL
    when no verdict could be read; ``status`` is the HTTP status of a rejected call and
    ``error`` the message of a call that broke. Adds ``outcome`` (allowed, blocked or
    scan_error) and replaces ``safe`` and ``reason`` on failed rows.

    Under ``open`` a failed scan passes, under ``closed`` it does not. Profile ``client``
    is the low-level client: it has no fail mode and reports every failure.
    """
    if mode not in ("open", "closed") or profile not in ("guard", "client"):
        raise ValueError(f"unknown fail mode or profile: {mode}, {profile}")
    noun = by_kind(F.col("content_kind"), ERROR_NOUNS)
    chat = F.col("content_kind") == PROMPT
    bad_status = F.col("status").isNotNull() & ~F.col("status").between(200, 299)
    status = F.col("status").cast("string")
    message = F.coalesce(F.col("error"), F.lit("invalid response"))
    timed_out = chat & message.contains("abort")
    failed = bad_status | F.col("error").isNotNull() | ~F.coalesce(F.col("usable"), F.lit(False))
    # only the chat path reports the bare message; the others stringify the error object
    detail = F.when(chat, message).otherwise(F.concat(F.lit("Error: "), message))
    open_text = (
        F.when(bad_status, F.concat(F.lit("Scan API error: "), status))
        .when(timed_out, TIMEOUT_OPEN)
        .otherwise(F.concat(F.lit("Scan error: "), detail))
    )
    status_text = F.concat(noun, F.lit(" API returned error: "), status)
    closed_text = (
        F.when(bad_status, status_text)
        .when(timed_out, TIMEOUT_CLOSED)
        .otherwise(F.concat(noun, F.lit(" failed: "), detail))
    )
    client_text = F.when(bad_status, status_text).otherwise(message)
    passes = mode == "open" and profile == "guard"
    text = open_text if passes else (client_text if profile == "client" else closed_text)
    others = [c for c in df.columns if c not in ("safe", "reason", "usable", "status", "error")]
    return df.withColumn("_failed", failed).select(
        *others,
        F.when(F.col("_failed"), F.lit(True if passes else None).cast("boolean")).otherwise(F.col("safe")).alias("safe"),
        F.when(F.col("_failed"), text).otherwise(F.col("reason")).alias("reason"),
        F.when(F.col("_failed"), "allowed" if passes else "scan_error")
        .when(F.col("safe"), "allowed")
        .otherwise("blocked")
        .alias("outcome"),
    )


def join_raw(items: DataFrame, raw: DataFrame) -> DataFrame:
    """Items with the imported scan result of the same request; items without one stay.

    Copies of a result are reduced to one per request before the join (a failed call loses
    to a readable one, an unsafe result wins), so a repeated id cannot multiply rows. The
    reduction and the join hash on the same key and share one exchange. VARIANT columns of
    ``raw`` are left behind.
    """
    # VARIANT values have no order; their typed fields are what counts here
    payload = [f.name for f in raw.schema.fields if f.name != "request_id" and not isinstance(f.dataType, T.VariantType)]
    order = [
        F.coalesce(F.col("usable"), F.lit(False)).alias("_u"),
        (~F.coalesce(F.col("safe"), F.lit(True))).alias("_v"),
    ]
    one = raw.groupBy("request_id").agg(F.max(F.struct(*order, *payload)).alias("_r"))
    return items.join(one, "request_id", "left").select(*items.columns, *[F.col(f"_r.{c}").alias(c) for c in payload])


def block_message(reason: Column, dialect: str = "a") -> Column:
    """What a blocked caller is told: dialects a and b prefix the reason, c does not."""
    if dialect == "c":
        return F.coalesce(non_empty(reason), F.lit(DEFAULT_BLOCK))
    return F.concat(F.lit("Request blocked: "), F.coalesce(non_empty(reason), F.lit(DEFAULT_THREAT)))


def gate(df: DataFrame, dialect: str = "a") -> DataFrame:
    """Add ``outcome`` (if absent) and ``message``; the row itself is left whole. An undecided
    item (``safe`` NULL) is a scan_error, never allowed."""
    if "outcome" not in df.columns:
        df = df.withColumn("outcome", F.when(F.col("safe"), "allowed").when(F.col("safe").isNull(), "scan_error").otherwise("blocked"))
    return df.withColumn(
        "message",
        F.when(F.col("outcome") == "blocked", block_message(F.col("reason"), dialect)).when(
            F.col("outcome") == "scan_error", F.col("reason")
        ),
    )


def gate_by_verdicts(items: DataFrame, verdicts: DataFrame, allowed: bool) -> DataFrame:
    """Whole item rows that pass (or do not pass) a separate table of outcomes.

    An item without any outcome does not pass. A request with several outcomes passes only
    if none of them stops it, so the stopping ids decide both sides.
    """
    passing = (
        verdicts.groupBy("request_id")
        .agg(F.bool_and(F.coalesce(F.col("outcome") == "allowed", F.lit(False))).alias("_pass"))
        .filter("_pass")
        .select("request_id")
    )
    return items.join(passing, "request_id", "left_semi" if allowed else "left_anti")
