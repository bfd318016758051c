"""Chat logs as tables of messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contentgate.functions import variants


def read_chat(spark: SparkSession, path: str, format: str = "parquet", keep_unreadable: bool = False) -> DataFrame:
    """One row per message: conv_id, turn, role and text or content.

    ``parquet`` (and other table formats) hold one message per row already. ``json`` holds
    one request per line, {"conv_id": …, "messages": [{"role": …, "content": …}, …]}; the
    place in the list becomes the turn, ``conv_id`` is text and ``content`` stays a VARIANT.
    ``keep_unreadable`` adds a column ``unreadable`` and, for each line without a list of messages, a row that holds
    the line there and nothing else, so that one scan of the file gives both.
    """
    if format != "json":
        return spark.read.format(format).load(path)
    return explode_requests(spark.read.text(path), keep_unreadable=keep_unreadable)


def explode_requests(lines: DataFrame, column: str = "value", keep_unreadable: bool = False) -> DataFrame:
    """Messages of JSON requests. A line that does not parse or has no list holds no messages;
    ``unreadable_requests`` gives those lines, ``keep_unreadable`` leaves them among the rows."""
    body = F.try_parse_json(F.col(column))
    requests = lines.select(body.alias("_request"), F.col(column).alias("_line"))
    messages = variants.elements(variants.field(F.col("_request"), "messages"))
    explode = F.posexplode_outer if keep_unreadable else F.posexplode
    rows = requests.select(
        F.try_variant_get(F.col("_request"), "$.conv_id", "string").alias("conv_id"),
        F.when(messages.isNull(), F.col("_line")).alias("unreadable"),
        explode(messages).alias("turn", "_message"),
    ).select(
        F.when(F.col("unreadable").isNull(), F.col("conv_id")).alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        variants.as_string(variants.field(F.col("_message"), "role")).alias("role"),
        variants.field(F.col("_message"), "content").alias("content"),
        "unreadable",
    )
    # an empty list is readable and has no message
    return rows.filter("turn IS NOT NULL OR unreadable IS NOT NULL") if keep_unreadable else rows.drop("unreadable")


def unreadable_requests(lines: DataFrame, column: str = "value") -> DataFrame:
    """The lines ``explode_requests`` reads no list of messages from."""
    request = F.try_parse_json(F.col(column))
    return lines.filter(variants.elements(variants.field(request, "messages")).isNull())
