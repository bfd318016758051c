"""Streaming queries, run over the test tables until all input is taken.

Each writes to the shared folder and reads the finished table back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from contentgate.functions import rules as R
from contentgate.operators.sessions import PATTERNS
from contentgate.plans.record_queries import _BUCKET_SQL, _SESSIONS, US
from contentgate.plans.registered import ORACLES, query, values_rows
from contentgate.plans.text_queries import PROMPT
from contentgate.session import configure, shared_dir
from contentgate.sources import items as I
from contentgate.sources.results import read_gated
from contentgate.streaming import buckets, gate, risk, timers
from contentgate.streaming.streams import read_stream, write_stream

DELAY_US = 600 * 1_000_000


def _stream(spark, sf_dir, table):
    path = f"{sf_dir}/{table}.parquet"
    schema = configure(spark).read.parquet(path).schema
    stream = read_stream(spark, path + "*", schema)
    return stream.select(*[
        F.col(f.name).cast("timestamp").alias(f.name) if f.dataType.simpleString() == "timestamp_ntz" else F.col(f.name)
        for f in schema.fields
    ])


def _finish(spark, stream):
    base = shared_dir(spark)
    write_stream(stream, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/out")


def _stream_prompts(spark, sf_dir):
    return I.build_items(_stream(spark, sf_dir, "documents"), R.PROMPT, F.expr(PROMPT),
                         request_id=F.col("doc_id").cast("string"))


@query("stream_gate", ORACLES["gate_blocked"])
def stream_gate(spark, sf_dir):
    base = shared_dir(spark)
    started = gate.start_gate(_stream_prompts(spark, sf_dir), f"{base}/out", f"{base}/checkpoint", kinds=(R.PROMPT,))
    started.awaitTermination()
    return read_gated(spark, f"{base}/out", allowed=False).select(
        "request_id", "outcome", "message", F.col("reason").alias("message_free")
    )


@query("stream_gate_allowed", ORACLES["gate_allowed"])
def stream_gate_allowed(spark, sf_dir):
    base = shared_dir(spark)
    started = gate.start_gate(_stream_prompts(spark, sf_dir), f"{base}/out", f"{base}/checkpoint", kinds=(R.PROMPT,))
    started.awaitTermination()
    return read_gated(spark, f"{base}/out").select("request_id", "content")


@query("stream_token_bucket", _BUCKET_SQL.format(rpm="10", squeeze=1000))
def stream_token_bucket(spark, sf_dir):
    requests = _stream(spark, sf_dir, "events").select(
        F.col("event_type").alias("api_key"), F.col("event_id").alias("request_id"),
        F.expr("unix_millis(ts) div 1000").alias("ms"),
    )
    return _finish(spark, buckets.token_bucket_stream(requests, rpm=10))


_RATES = "CASE event_type WHEN 'view' THEN 20 WHEN 'click' THEN 50 WHEN 'error' THEN NULL ELSE 40 END"


@query(
    "stream_token_bucket_settled",
    f"""
SELECT request_id, api_key, ms, {_RATES.replace('event_type', 'api_key')} AS rpm, allowed, remaining, retry_after_ms
FROM ({_BUCKET_SQL.format(rpm=_RATES, squeeze=1000)})
WHERE api_key <> 'error' AND (ms // 60000 + 1) * 60000 <= (SELECT max((epoch_us(ts) // 1000) // 1000) FROM events WHERE event_type <> 'error') - 60000
UNION ALL
SELECT event_id, event_type, (epoch_us(ts) // 1000) // 1000, NULL, TRUE, NULL, NULL FROM events WHERE event_type = 'error'""",
)
def stream_token_bucket_settled(spark, sf_dir):
    """A rate per key, one without a limit; what the watermark has not passed is still open."""
    requests = _stream(spark, sf_dir, "events").select(
        F.col("event_type").alias("api_key"), F.col("event_id").alias("request_id"),
        F.expr("unix_millis(ts) div 1000").alias("ms"), F.expr(_RATES).alias("rpm"))
    return _finish(spark, buckets.settled_bucket_stream(requests, rpm=F.col("rpm")))


@query(
    "stream_session_risk",
    f"""
SELECT user_id, min(us) AS first_us, count(*) AS n_requests,
       round(1 - exp(coalesce(sum(ln(1 - 0.3)) FILTER (WHERE bad), 0)), 6) AS session_risk_score
FROM (SELECT s.*, e.event_type = 'error' AS bad FROM ({_SESSIONS}) s JOIN events e USING (event_id))
GROUP BY user_id, session_no
HAVING max(us) + 1800000000 <= ((SELECT max({US}) FROM events) // 1000 - 600000) * 1000""",
)
def stream_session_risk(spark, sf_dir):
    verdicts = _stream(spark, sf_dir, "events").select(
        "user_id", "ts", (F.col("event_type") != "error").alias("safe"), F.lit("high").alias("severity")
    )
    return _finish(spark, risk.session_risk_stream(verdicts))


@query(
    "stream_session_patterns",
    f"""
WITH e AS (SELECT user_id, event_id, {US} // 100 AS us, (event_id % 5)::VARCHAR AS digest,
    CASE WHEN event_type = 'error' THEN 'prompt_injection' WHEN event_id % 11 = 0 THEN 'data_leak' END AS tt FROM events),
n AS (SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY user_id ORDER BY us, event_id) <= 600000000 THEN 0 ELSE 1 END AS starts FROM e),
v AS (SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY us, event_id ROWS UNBOUNDED PRECEDING) AS no FROM n),
d AS (SELECT user_id, no, digest, min(us) AS first_us, max(us) AS last_us, count(tt) AS blocked, min(tt) AS lo, max(tt) AS hi,
    coalesce(max(us) > min(us) FILTER (tt IS NOT NULL), FALSE) AS again FROM v GROUP BY ALL),
s AS (SELECT user_id, min(first_us) AS first_us, sum(blocked) AS blocked, min(lo) AS lo, max(hi) AS hi, bool_or(again) AS again FROM d GROUP BY user_id, no
    HAVING ((max(last_us) + 600000000) // 300000000 + 1) * 300000000 <= ((SELECT max(us) FROM e) // 1000 - 600000) * 1000)
SELECT user_id, first_us, pattern_id, pattern_name, category, confidence::DOUBLE AS confidence, description
FROM s JOIN (VALUES {values_rows(PATTERNS)}) p(pattern_id, pattern_name, category, confidence, description)
  ON CASE pattern_id WHEN 'repeat_offender' THEN blocked >= 3 WHEN 'probing' THEN lo <> hi ELSE again END""",
)
def stream_session_patterns(spark, sf_dir):
    """A clock a hundred times as fast, so that sessions have several turns."""
    verdicts = _stream(spark, sf_dir, "events").select(
        "user_id", F.expr("timestamp_micros(unix_micros(ts) div 100)").alias("ts"), (F.col("event_id") % 5).cast("string").alias("digest"),
        F.when(F.col("event_type") == "error", "prompt_injection").when(F.col("event_id") % 11 == 0, "data_leak").alias("threat_type"))
    return _finish(spark, risk.session_patterns_stream(verdicts.withColumn("safe", F.col("threat_type").isNull()), gap_us=600_000_000))


@query(
    "stream_liveness",
    f"""
WITH a AS (SELECT user_id AS agent_id, epoch_us(min(ts)) // 1000 AS first_ms, epoch_us(max(ts)) // 1000 AS last_ms FROM events GROUP BY 1)
SELECT agent_id, 'active' AS status, first_ms AS at_ms FROM a
UNION ALL
SELECT agent_id, 'inactive', last_ms FROM a
WHERE last_ms + 21600000 <= (SELECT max({US}) FROM events) // 1000 - 600000""",
)
def stream_liveness(spark, sf_dir):
    beats = _stream(spark, sf_dir, "events").select(F.col("user_id").alias("agent_id"), "ts")
    return _finish(spark, timers.liveness_stream(beats, after_ms=6 * 3600 * 1000))


@query(
    "stream_approval_expiry",
    f"""
SELECT concat('a', event_id) AS approval_id, {US} // 1000 + (event_id % 20) * 86400000 AS expired_ms
FROM events WHERE event_type = 'signup'
  AND {US} // 1000 + (event_id % 20) * 86400000
      <= (SELECT max({US}) FROM events WHERE event_type = 'signup') // 1000 - 600000""",
)
def stream_approval_expiry(spark, sf_dir):
    granted = _stream(spark, sf_dir, "events").filter("event_type = 'signup'").select(
        F.concat(F.lit("a"), F.col("event_id").cast("string")).alias("approval_id"), "ts",
        ((F.col("event_id") % 20) * 86400).alias("expires_in_seconds"),
    )
    return _finish(spark, timers.expiry_stream(granted))


@query("stream_dedup", "SELECT DISTINCT concat('r', event_id // 3) AS request_id FROM events")
def stream_dedup(spark, sf_dir):
    # three deliveries of each request share an id
    items = _stream(spark, sf_dir, "events").select(
        F.concat(F.lit("r"), F.expr("event_id div 3").cast("string")).alias("request_id"), "ts"
    )
    return _finish(spark, gate.first_of_requests(items)).select("request_id")
