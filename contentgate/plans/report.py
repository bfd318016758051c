"""Reports over verdicts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contentgate.functions import taxonomy


def governance_report(verdicts: DataFrame) -> DataFrame:
    """Counts by kind, outcome, threat, severity and level."""
    return verdicts.groupBy("content_kind", "safe", "threat_type", "severity", "confidence").agg(
        F.count(F.lit(1)).alias("n_items")
    )


def compliance_report(verdicts: DataFrame) -> DataFrame:
    """Unsafe items per framework and threat. Counted per threat first: the labels are
    attached to at most one row per threat type."""
    per_type = verdicts.filter(~F.col("safe")).groupBy("threat_type").agg(F.count(F.lit(1)).alias("_n"))
    return (
        per_type.select(F.explode(taxonomy.frameworks(F.col("threat_type"))).alias("framework"), "threat_type", "_n")
        .groupBy("framework", "threat_type")
        .agg(F.sum("_n").alias("n_items"))
    )
