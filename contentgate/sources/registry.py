"""Registry snapshots: policies and agents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

POLICY_SCHEMA = (
    "policy_id string, customer_id string, name string, description string, "
    "rules array<struct<type:string,action:string,threshold:double,patterns:array<string>>>, "
    "is_default boolean, created_at timestamp, updated_at timestamp"
)
AGENT_SCHEMA = (
    "agent_id string, customer_id string, name string, description string, api_key string, policy_id string, "
    "status string, created_at timestamp, last_heartbeat timestamp"
)


def _read(spark: SparkSession, path: str, schema: str, format: str, keep_unreadable: bool) -> DataFrame:
    if format != "json":
        return spark.read.format(format).load(path)
    if keep_unreadable:
        return spark.read.schema(f"{schema}, unreadable string").option("columnNameOfCorruptRecord", "unreadable").json(path)
    return spark.read.schema(schema).json(path)


def read_policies(
    spark: SparkSession, path: str, policy_id: str | None = None, format: str = "json", keep_unreadable: bool = False
) -> DataFrame:
    """All policies, or the one with the given id (the filter reaches the scan). ``keep_unreadable`` adds a column with
    the text of a JSON line that does not fit the schema; of such a line what fits is read."""
    table = _read(spark, path, POLICY_SCHEMA, format, keep_unreadable)
    return table if policy_id is None else table.filter(F.col("policy_id") == policy_id)


def read_agents(
    spark: SparkSession, path: str, agent_id: str | None = None, format: str = "json", keep_unreadable: bool = False
) -> DataFrame:
    """Agents without their API key: it is replaced by a digest at the source. A line that does not fit the schema may
    hold a key in clear, so ``keep_unreadable`` gives the digest of such a line."""
    table = _read(spark, path, AGENT_SCHEMA, format, keep_unreadable).withColumn("api_key", F.sha2(F.col("api_key"), 256))
    if keep_unreadable and format == "json":
        table = table.withColumn("unreadable", F.sha2("unreadable", 256))
    return table if agent_id is None else table.filter(F.col("agent_id") == agent_id)
