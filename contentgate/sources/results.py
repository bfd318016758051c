"""Raw scan results in, gated items out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contentgate.operators.verdicts import read_fields


def parse_raw(df: DataFrame, column: str = "body") -> DataFrame:
    """Parse a column of JSON responses. ``raw`` is NULL where the text is not JSON; such
    rows, and JSON null, come out with ``usable`` = false."""
    return read_fields(df.withColumn("raw", F.try_parse_json(F.col(column))), "raw")


def read_raw_verdicts(spark: SparkSession, path: str) -> DataFrame:
    """One JSON response per line; the request id is read from the response."""
    lines = spark.read.text(path).withColumnRenamed("value", "body")
    parsed = lines.withColumn("raw", F.try_parse_json("body"))
    return read_fields(parsed, "raw").withColumn(
        "request_id", F.try_variant_get(F.col("raw"), "$.request_id", "string")
    )


def write_gated(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write gated items once, split by outcome and kind: allowed items and the quarantine
    are folders of one table, so the scan runs a single time and nothing is cached. An
    earlier quarantine is only replaced or added to if ``mode`` says so."""
    df.write.mode(mode).partitionBy("outcome", "content_kind").parquet(path)


def read_gated(spark: SparkSession, path: str, allowed: bool = True) -> DataFrame:
    """The allowed items or the quarantine; the filter prunes the folders."""
    table = spark.read.parquet(path)
    return table.filter(F.col("outcome") == "allowed") if allowed else table.filter(F.col("outcome") != "allowed")
