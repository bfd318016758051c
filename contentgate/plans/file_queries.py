"""Reading files: each query writes lines made from the test tables, broken ones among them, and reads them back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contentgate.functions import variants
from contentgate.plans.record_queries import _RAW_SQL, _raw
from contentgate.plans.registered import load, query
from contentgate.session import shared_dir
from contentgate.sources.chat import read_chat
from contentgate.sources.registry import read_agents, read_policies
from contentgate.sources.results import read_raw_verdicts


def _written(lines: DataFrame) -> str:
    path = shared_dir(lines.sparkSession)
    lines.write.text(path)
    return path


@query(
    "chat_source_json",
    """
WITH c AS (SELECT conv_id, turn // 8 AS part, role, text, row_number() OVER (PARTITION BY conv_id, turn // 8 ORDER BY turn) - 1 AS turn FROM conversations)
SELECT conv_id::VARCHAR AS conv_id, turn, role, text, NULL::VARCHAR AS unreadable FROM c WHERE (conv_id + part) % 7 <> 3
UNION ALL
SELECT DISTINCT NULL::VARCHAR, NULL::BIGINT, NULL::VARCHAR, NULL::VARCHAR, concat('{"conv_id": ', conv_id, ', "messages": [', part) FROM c WHERE (conv_id + part) % 7 = 3""",
)
def chat_source_json(spark, sf_dir):
    """Requests of up to eight turns; a seventh of the lines is cut off."""
    turns = load(spark, sf_dir, "conversations").withColumn("part", F.expr("turn div 8"))
    requests = turns.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))).alias("messages"))
    cut = F.concat(F.lit('{"conv_id": '), F.col("conv_id").cast("string"), F.lit(', "messages": ['), F.col("part").cast("string"))
    path = _written(requests.select(
        F.when((F.col("conv_id") + F.col("part")) % 7 == 3, cut).otherwise(F.to_json(F.struct("conv_id", "messages"))).alias("value")))
    rows = read_chat(spark, path, "json", keep_unreadable=True)
    return rows.select("conv_id", "turn", "role", variants.as_string(F.col("content")).alias("text"), "unreadable")


@query(
    "raw_verdict_file",
    f"""
SELECT body, json_extract_string(j, '$.request_id') AS request_id, coalesce(parsed, FALSE) AND NOT (coalesce(unsafe_raw, FALSE) AND bad_type) AS usable,
       NOT coalesce(unsafe_raw, FALSE) AS safe, threat_type, severity, confidence_score, reason
FROM (SELECT * EXCLUDE (request_id) FROM ({_RAW_SQL}))""",
)
def raw_verdict_file(spark, sf_dir):
    path = _written(_raw(spark, sf_dir).select(F.col("body").alias("value")))
    return read_raw_verdicts(spark, path).select(
        "body", "request_id", "usable", "safe", "threat_type", "severity", "confidence_score", "reason")


@query(
    "agent_registry_file",
    """
SELECT concat('agent-', c_custkey) AS agent_id, c_nationkey::VARCHAR AS customer_id, c_name AS name, sha256(concat('key ', c_mktsegment)) AS api_key,
       CASE WHEN c_custkey % 9 <> 0 THEN (c_custkey % 200)::VARCHAR END AS policy_id, NULL::VARCHAR AS unreadable FROM customer WHERE c_custkey % 13 <> 5
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, sha256(concat('{"agent_id": "agent-', c_custkey, '", "api_key": "key ', c_mktsegment)) FROM customer WHERE c_custkey % 13 = 5""",
)
def agent_registry_file(spark, sf_dir):
    """A thirteenth of the lines is cut off behind the key."""
    name, key = F.concat(F.lit("agent-"), F.col("c_custkey").cast("string")), F.concat(F.lit("key "), F.col("c_mktsegment"))
    line = F.to_json(F.struct(
        name.alias("agent_id"), F.col("c_nationkey").cast("string").alias("customer_id"), F.col("c_name").alias("name"), key.alias("api_key"),
        F.when(F.col("c_custkey") % 9 != 0, (F.col("c_custkey") % 200).cast("string")).alias("policy_id")))
    cut = F.concat(F.lit('{"agent_id": "'), name, F.lit('", "api_key": "'), key)
    path = _written(load(spark, sf_dir, "customer").select(F.when(F.col("c_custkey") % 13 == 5, cut).otherwise(line).alias("value")))
    return read_agents(spark, path, keep_unreadable=True).select("agent_id", "customer_id", "name", "api_key", "policy_id", "unreadable")


@query(
    "policy_registry_file",
    """
SELECT s_suppkey::VARCHAR AS policy_id, s_name AS name, 'custom' AS type, CASE WHEN n = 1 THEN 'warn' ELSE 'block' END AS action,
       0.25 * n AS threshold, concat('p', n, ',', s_suppkey % 5) AS patterns, NULL::VARCHAR AS unreadable
FROM supplier, range(1, 4) r(n) WHERE n <= s_suppkey % 4 AND s_suppkey % 6 <> 1
UNION ALL
SELECT s_suppkey::VARCHAR, s_name, NULL, NULL, NULL, NULL, NULL FROM supplier WHERE s_suppkey % 4 = 0 AND s_suppkey % 6 <> 1
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL, concat('{"policy_id": "', s_suppkey) FROM supplier WHERE s_suppkey % 6 = 1""",
)
def policy_registry_file(spark, sf_dir):
    """Up to three rules a policy, one row each; a sixth of the lines is cut off."""
    rule = lambda n: F.struct(
        F.lit("custom").alias("type"), F.when(n == 1, "warn").otherwise("block").alias("action"), (n * 0.25).alias("threshold"),
        F.array(F.concat(F.lit("p"), n.cast("string")), (F.col("s_suppkey") % 5).cast("string")).alias("patterns"))
    count = (F.col("s_suppkey") % 4).cast("int")
    rules = F.when(count > 0, F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), rule))
    line = F.to_json(F.struct(F.col("s_suppkey").cast("string").alias("policy_id"), F.col("s_name").alias("name"), rules.alias("rules")))
    cut = F.concat(F.lit('{"policy_id": "'), F.col("s_suppkey").cast("string"))
    path = _written(load(spark, sf_dir, "supplier").select(F.when(F.col("s_suppkey") % 6 == 1, cut).otherwise(line).alias("value")))
    rows = read_policies(spark, path, keep_unreadable=True).select("policy_id", "name", F.explode_outer("rules").alias("r"), "unreadable")
    return rows.select("policy_id", "name", "r.type", "r.action", "r.threshold", F.array_join("r.patterns", ",").alias("patterns"), "unreadable")
