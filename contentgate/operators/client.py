"""The low-level client's path: size gate, rate limit, scan, public verdict."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contentgate.functions import rules as R
from contentgate.operators.gates import MAX_UNITS, NOT_SCANNED, size_gate
from contentgate.operators.metering import DEFAULT_RPM, token_bucket
from contentgate.operators.scan import scan_raw
from contentgate.operators.verdicts import sanitize_verdicts


def with_history(content: Column, history: Column) -> Column:
    """A prompt and the turns sent along with it; no rule matches across the line feed."""
    return F.when(F.coalesce(history, F.lit("")) != "", F.concat_ws("\n", content, history)).otherwise(content)


def client_scan(items: DataFrame, rpm: int | Column = DEFAULT_RPM, pack: str = "core", limit: int = MAX_UNITS,
                kinds: tuple = R.KINDS, key: str = "api_key", clock: str = "ms") -> DataFrame:
    """Every item with its verdict, ``violations``, ``retry_after_ms``, ``outcome`` and ``message``.

    Outcomes: ``blocked`` for unsafe and for oversized items (which cost no token and are not
    scanned, and keep their violations), ``rate_limited`` for requests without a token,
    ``scan_error`` for kinds that are not scanned, else ``allowed``. The body of a prompt is the
    history sent with it: it counts towards the size and is scanned like the prompt.
    """
    sized = size_gate(items, limit)
    # an oversized item has no place in the queue for tokens
    queued = sized.withColumn("_clock", F.when(~F.col("too_large"), F.col(clock)))
    metered = token_bucket(queued, rpm, key, "_clock")
    denied = F.coalesce(~F.col("allowed"), F.lit(False))
    ready = metered.withColumn("_denied", denied).withColumn("_content", F.col("content")).withColumn(
        "content", F.when(F.col("content_kind") == R.PROMPT, with_history(F.col("content"), F.col("body"))).otherwise(F.col("content")))
    scanned = scan_raw(ready, pack, kinds=kinds, skip=F.col("too_large") | F.col("_denied"))
    large = F.col("too_large")
    settled = scanned.select(
        *[F.col("_content").alias("content") if c == "content" else F.col(c) for c in items.columns],
        "usable", "violations", F.when(F.col("_denied"), F.col("retry_after_ms")).alias("retry_after_ms"), "_denied",
        F.when(large, False).otherwise(F.col("safe")).alias("safe"),
        F.when(large, "size_limit_exceeded").otherwise(F.col("threat_type")).alias("threat_type"),
        "severity",
        F.when(large, F.col("size_score")).otherwise(F.col("confidence_score")).alias("confidence_score"),
        F.coalesce(F.col("size_reason"), F.col("reason")).alias("reason"),
    )
    done = sanitize_verdicts(settled, (*items.columns, "violations", "retry_after_ms", "_denied"))
    waiting = F.coalesce(F.concat(F.lit("Rate limit exceeded. Retry after "), F.col("retry_after_ms").cast("string"), F.lit("ms")),
                         F.lit("Rate limit exceeded"))
    verdict = [F.when(~F.col("_denied"), F.col(c)).alias(c) for c in ("safe", "threat_type", "severity", "confidence", "guidance", "approval_info")]
    return done.select(
        *items.columns, *verdict,
        F.when(F.col("_denied"), waiting).when(F.col("safe").isNull(), NOT_SCANNED).otherwise(F.col("reason")).alias("reason"),
        "violations", "retry_after_ms",
        F.when(F.col("_denied"), "rate_limited").when(F.col("safe").isNull(), "scan_error").when(F.col("safe"), "allowed")
        .otherwise("blocked").alias("outcome"),
    ).withColumn("message", F.when(F.col("outcome") != "allowed", F.col("reason")))
