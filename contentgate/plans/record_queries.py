"""Queries over verdicts, failed scans, policies, approvals, metering and sessions."""

from __future__ import annotations

from pyspark.sql import functions as F

from contentgate.functions import rules as R
from contentgate.functions import taxonomy as X
from contentgate.functions.text import epoch_ms
from contentgate.operators import agents, approvals, gates, metering, policy, scan, sessions, verdicts
from contentgate.plans.registered import load, query, sql_text, values_rows
from contentgate.plans.scan_queries import CORE_TEXT, TYPES
from contentgate.plans.text_queries import PROMPT, prompt_items
from contentgate.sources import items as I
from contentgate.sources.results import parse_raw

ALIASES = values_rows(X.THREAT_ALIASES.items())
US = "epoch_us(ts)"

# --- raw results -------------------------------------------------------------
# event_id % 16 -> JSON response; written so that both engines build the same text.
_BODIES = (
    '{"safe":true,"reason":"No threats detected"}',
    '{"safe":true}',
    '{"safe":false,"threat_type":"pii","confidence":0.99,"reason":"PII detected","violations":[{"type":"ssn"}],"detected_by":"x"}',
    '{"safe":false,"threat_type":"jailbreak","confidence":0.88,"matched_text":"abc","policy_name":"p"}',
    "{}",
    '{"safe":null}',
    '{"safe":"false"}',
    '{"safe":0}',
    '{"safe":false,"threat_type":"SQL-Injection","severity":"HIGH","confidence":"0.95"}',
    '{"safe":false,"threat_type":" pii ","severity":"urgent","reason":""}',
    '{"safe":false,"threat_type":5}',
    "null",
    "{not json",
    '{"safe":false,"threat_type":"Tautology-OR","confidence":0.6999,"severity":3}',
    '{"safe":false,"confidence":0.7,"performance":{"ms":3},"reason":"odd"}',
    '{"safe":false,"threat_type":"harmful_content","confidence":0.9,"approval_info":{"requires_approval":true,'
    '"approval_id":"a@","approval_level":"manager","action_summary":"run","policy_name":"strict",'
    '"expires_in_seconds":600,"risk_factors":["x","y"]}}',
)


def _case(key: str, values) -> str:
    return f"CASE {key} " + " ".join(f"WHEN {i} THEN {sql_text(v)}" for i, v in enumerate(values)) + " END"


_BODY = f"replace({_case('event_id % 16', _BODIES)}, '@', CAST(event_id AS STRING))"


def _raw(spark, sf_dir):
    events = load(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("request_id"), F.expr(_BODY).alias("body")
    )
    return parse_raw(events)


_RAW_SQL = f"""
SELECT CAST(event_id AS VARCHAR) AS request_id, body, json_valid(body) AND json_type(j) <> 'NULL' AS parsed,
       json_type(j, '$.safe') = 'BOOLEAN' AND json_extract_string(j, '$.safe') = 'false' AS unsafe_raw,
       CASE WHEN json_type(j, '$.threat_type') = 'VARCHAR' THEN json_extract_string(j, '$.threat_type') END AS threat_type,
       coalesce(json_type(j, '$.threat_type') NOT IN ('VARCHAR', 'NULL'), FALSE) AS bad_type,
       CASE WHEN json_type(j, '$.severity') = 'VARCHAR' THEN json_extract_string(j, '$.severity') END AS severity,
       CASE WHEN json_type(j, '$.confidence') IN ('DOUBLE', 'UBIGINT', 'BIGINT')
            THEN CAST(json_extract_string(j, '$.confidence') AS DOUBLE) END AS confidence_score,
       nullif(json_extract_string(j, '$.reason'), '') AS reason, j
FROM (SELECT event_id, body, CASE WHEN json_valid(body) THEN body::JSON END AS j
      FROM (SELECT event_id, {_BODY.replace('STRING', 'VARCHAR')} AS body FROM events))"""


@query(
    "raw_verdict_parse",
    f"""
SELECT request_id, coalesce(parsed, FALSE) AND NOT (coalesce(unsafe_raw, FALSE) AND bad_type) AS usable,
       NOT coalesce(unsafe_raw, FALSE) AS safe, threat_type, severity, confidence_score, reason
FROM ({_RAW_SQL})""",
)
def raw_verdict_parse(spark, sf_dir):
    return _raw(spark, sf_dir).select(
        "request_id", "usable", "safe", "threat_type", "severity", "confidence_score", "reason"
    )


_SANITIZED = f"""
SELECT r.request_id, NOT unsafe_raw IS TRUE AS safe,
       CASE WHEN unsafe_raw THEN tt END AS threat_type,
       CASE WHEN unsafe_raw THEN CASE WHEN lower(r.severity) IN ('critical', 'high', 'medium', 'low')
            THEN lower(r.severity) ELSE y.severity END END AS severity,
       CASE WHEN unsafe_raw THEN CASE WHEN confidence_score IS NULL THEN 'medium' WHEN confidence_score >= 0.9 THEN 'high'
            WHEN confidence_score >= 0.7 THEN 'medium' ELSE 'low' END END AS confidence,
       CASE WHEN unsafe_raw THEN coalesce(reason, y.guidance) ELSE coalesce(reason, '') END AS reason,
       CASE WHEN unsafe_raw THEN y.guidance END AS guidance, j,
       parsed AND NOT (coalesce(unsafe_raw, FALSE) AND bad_type) AS usable
FROM (SELECT *, coalesce(m.tt0, 'unknown') AS tt FROM ({_RAW_SQL})
      LEFT JOIN (VALUES {ALIASES}) m(alias, tt0) ON m.alias = replace(lower(threat_type), '-', '_')) r
LEFT JOIN (VALUES {TYPES}) y(tt, severity, guidance) USING (tt)"""


@query(
    "sanitize_verdicts",
    "SELECT request_id, " + ", ".join(f"CASE WHEN usable THEN {c} END AS {c}" for c in
        ("safe", "threat_type", "severity", "confidence", "reason", "guidance"))
    + f", CASE WHEN request_id::BIGINT % 3 = 0 THEN {sql_text(verdicts.NO_KEY_NOTE)} END AS note FROM ({_SANITIZED})",
)
def sanitize_verdicts(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    keyed = raw.withColumn("api_key", F.when(F.col("request_id").cast("bigint") % 3 != 0, "key"))
    return verdicts.sanitize_verdicts(keyed, api_key="api_key").drop("approval_info")


@query(
    "sanitize_approval",
    f"""
SELECT request_id, CASE WHEN usable THEN safe END AS safe, json_extract_string(j, '$.approval_info.approval_id') AS approval_id,
       (json_extract_string(j, '$.approval_info.requires_approval') = 'true') AS requires_approval,
       json_extract_string(j, '$.approval_info.policy_name') AS policy_name,
       CAST(json_extract_string(j, '$.approval_info.expires_in_seconds') AS BIGINT) AS expires_in_seconds,
       CASE WHEN json_type(j, '$.approval_info') = 'OBJECT' THEN 'x,y' END AS risk_factors, NULL::VARCHAR AS owasp_category
FROM ({_SANITIZED})""",
)
def sanitize_approval(spark, sf_dir):
    done = verdicts.sanitize_verdicts(_raw(spark, sf_dir))
    return done.select(
        "request_id", "safe", "approval_info.approval_id", "approval_info.requires_approval",
        "approval_info.policy_name", "approval_info.expires_in_seconds",
        F.array_join("approval_info.risk_factors", ",").alias("risk_factors"), "approval_info.owasp_category",
    )


@query(
    "sanitize_labels",
    f"""
SELECT CAST(doc_id AS VARCHAR) AS request_id, toxic <> 1 AS safe, CASE WHEN toxic = 1 THEN 'toxicity' END AS threat_type,
       CASE WHEN toxic = 1 THEN 'medium' END AS severity, CASE WHEN toxic = 1 THEN
         CASE WHEN quality = 1 THEN 'high' ELSE 'medium' END END AS confidence,
       CASE WHEN toxic = 1 THEN {sql_text(X.THREAT_GUIDANCE['toxicity'])} ELSE '' END AS reason
FROM labels JOIN documents USING (doc_id)""",
)
def sanitize_labels(spark, sf_dir):
    rated = load(spark, sf_dir, "labels").join(load(spark, sf_dir, "documents").select("doc_id"), "doc_id")
    raw = rated.select(
        F.col("doc_id").cast("string").alias("request_id"), (F.col("toxic") != 1).alias("safe"),
        F.lit("harmful_content").alias("threat_type"), F.lit(None).cast("string").alias("severity"),
        F.when(F.col("quality") == 1, 0.9).otherwise(0.75).alias("confidence_score"),
        F.lit("").alias("reason"),
    )
    return verdicts.sanitize_verdicts(raw).drop("approval_info", "guidance")


@query(
    "leak_audit",
    f"SELECT f.field, count(*) AS n_rows FROM ({_RAW_SQL}) r, (VALUES {values_rows([(x,) for x in X.INTERNAL_FIELDS])}) "
    "f(field) WHERE json_exists(r.j, '$.' || f.field) GROUP BY 1",
)
def leak_audit(spark, sf_dir):
    return verdicts.leak_audit(_raw(spark, sf_dir))


_NAMES = [
    *X.THREAT_ALIASES, "SQL-Injection", "Tautology-OR", " pii ", "zzz", "", "Prompt-Injection", "PII", "constructor",
    "data--leak", "API-KEY",
]
_RAW_NAME = f"CASE WHEN event_id % 11 = 0 THEN NULL ELSE {{0}} END"
_NAME_LIST = ", ".join(sql_text(n) for n in _NAMES)


def _named(spark, sf_dir):
    names = F.array(*[F.lit(n) for n in _NAMES])
    picked = F.get(names, (F.col("event_id") % len(_NAMES)).cast("int"))
    return load(spark, sf_dir, "events").withColumn("raw_type", F.when(F.col("event_id") % 11 != 0, picked))


_NAMED_SQL = (
    f"SELECT e.*, coalesce(m.tt, 'unknown') AS threat_type FROM ("
    f"SELECT *, CASE WHEN event_id % 11 <> 0 THEN [{_NAME_LIST}][event_id % {len(_NAMES)} + 1] END AS raw_type FROM events) e "
    f"LEFT JOIN (VALUES {ALIASES}) m(alias, tt) ON m.alias = replace(lower(e.raw_type), '-', '_')"
)


@query("normalize_threat", f"SELECT event_id, raw_type, threat_type FROM ({_NAMED_SQL})")
def normalize_threat(spark, sf_dir):
    return _named(spark, sf_dir).select("event_id", "raw_type", X.threat_type(F.col("raw_type")).alias("threat_type"))


_SEV_CASES = ("HIGH", "urgent", "", "Low", "critical", " medium ")
_SEV_TEXT = _case("event_id % 7", _SEV_CASES)


@query(
    "derive_severity",
    f"""
SELECT event_id, n.threat_type, CASE WHEN lower({_SEV_TEXT}) IN ('critical', 'high', 'medium', 'low')
       THEN lower({_SEV_TEXT}) ELSE y.severity END AS severity
FROM ({_NAMED_SQL}) n JOIN (VALUES {TYPES}) y(threat_type, severity, guidance) USING (threat_type)""",
)
def derive_severity(spark, sf_dir):
    typed = _named(spark, sf_dir).withColumn("threat_type", X.threat_type(F.col("raw_type")))
    return typed.select(
        "event_id", "threat_type", X.severity(F.col("threat_type"), F.expr(_SEV_TEXT)).alias("severity")
    )


@query(
    "guidance_join",
    f"SELECT event_id, n.threat_type, y.guidance FROM ({_NAMED_SQL}) n "
    f"JOIN (VALUES {TYPES}) y(threat_type, severity, guidance) USING (threat_type)",
)
def guidance_join(spark, sf_dir):
    typed = _named(spark, sf_dir).withColumn("threat_type", X.threat_type(F.col("raw_type")))
    return typed.select("event_id", "threat_type", X.guidance(F.col("threat_type")).alias("guidance"))


@query(
    "bucket_confidence",
    """
SELECT event_id, CASE WHEN event_id % 13 = 0 THEN 'medium' WHEN event_id % 17 = 0 THEN 'low'
       WHEN (event_id % 101) / 100.0 >= 0.9 THEN 'high' WHEN (event_id % 101) / 100.0 >= 0.7 THEN 'medium'
       ELSE 'low' END AS confidence FROM events""",
)
def bucket_confidence(spark, sf_dir):
    score = F.when(F.col("event_id") % 13 == 0, None).when(F.col("event_id") % 17 == 0, F.lit(float("nan"))).otherwise(
        (F.col("event_id") % 101) / 100
    )
    return load(spark, sf_dir, "events").select("event_id", X.confidence_level(score).alias("confidence"))


# --- failed scans ------------------------------------------------------------
_KIND_OF = "CASE event_id % 4 WHEN 1 THEN 'sql' WHEN 2 THEN 'file_path' ELSE 'prompt' END"


def _failures(spark, sf_dir, mode, profile="guard"):
    events = load(spark, sf_dir, "events")
    items = events.select(F.col("event_id").cast("string").alias("request_id"), F.expr(_KIND_OF).alias("content_kind"))
    broken = F.col("event_type") == "error"
    case = F.col("event_id") % 3
    body = F.when(~broken, F.when(F.col("event_id") % 5 == 0, F.lit(_BODIES[2])).otherwise(F.lit(_BODIES[0])))
    responses = events.filter("event_id % 10 <> 9").select(
        F.col("event_id").cast("string").alias("request_id"),
        body.alias("body"),
        F.when(broken & (case == 0), 500).when(~broken, 200).alias("status"),
        F.when(broken & (case == 1), "This operation was aborted").when(broken & (case == 2), "Network error").alias("error"),
    )
    raw = parse_raw(responses).select("request_id", "status", "error", "usable", "safe", "reason")
    # every response arrives twice: copies must not multiply the items
    joined = gates.join_raw(items, raw.unionByName(raw))
    return gates.resolve_fail_mode(joined, mode, profile)


def _failure_sql(open_mode: bool, client: bool = False) -> str:
    noun = "CASE k WHEN 'sql' THEN 'SQL scan' WHEN 'file_path' THEN 'File scan' ELSE 'Scan' END"
    detail = "CASE k WHEN 'prompt' THEN msg ELSE concat('Error: ', msg) END"
    if open_mode:
        text = (
            "CASE WHEN f = 0 THEN 'Scan API error: 500' WHEN f = 1 AND k = 'prompt' THEN 'Scan timeout, failing open' "
            f"ELSE concat('Scan error: ', {detail}) END"
        )
    elif client:
        text = f"CASE WHEN f = 0 THEN concat({noun}, ' API returned error: 500') ELSE msg END"
    else:
        text = (
            f"CASE WHEN f = 0 THEN concat({noun}, ' API returned error: 500') WHEN f = 1 AND k = 'prompt' "
            f"THEN 'Scan request timed out and fail_mode is ''closed''' ELSE concat({noun}, ' failed: ', {detail}) END"
        )
    return f"""
SELECT request_id, k AS content_kind,
       CASE WHEN f IS NOT NULL THEN {'TRUE' if open_mode else 'NULL::BOOLEAN'} ELSE event_id % 5 <> 0 END AS safe,
       CASE WHEN f IS NOT NULL THEN {text} WHEN event_id % 5 = 0 THEN 'PII detected' ELSE 'No threats detected' END AS reason,
       CASE WHEN f IS NOT NULL THEN '{'allowed' if open_mode else 'scan_error'}'
            WHEN event_id % 5 = 0 THEN 'blocked' ELSE 'allowed' END AS outcome
FROM (SELECT *, CASE f WHEN 1 THEN 'This operation was aborted' WHEN 2 THEN 'Network error' ELSE 'invalid response' END AS msg
  FROM (SELECT event_id, CAST(event_id AS VARCHAR) AS request_id, {_KIND_OF} AS k,
          CASE WHEN event_id % 10 = 9 THEN 3 WHEN event_type = 'error' THEN event_id % 3 END AS f FROM events))"""


@query("fail_mode_open", _failure_sql(True))
def fail_mode_open(spark, sf_dir):
    return _failures(spark, sf_dir, "open")


@query("fail_mode_closed", _failure_sql(False))
def fail_mode_closed(spark, sf_dir):
    return _failures(spark, sf_dir, "closed")


@query("fail_mode_client", _failure_sql(False, client=True))
def fail_mode_client(spark, sf_dir):
    return _failures(spark, sf_dir, "closed", profile="client")


# --- policies ----------------------------------------------------------------
def change_log(spark, sf_dir):
    """Sign-ups create, clicks and views update one field, errors delete."""
    rule = F.struct(
        F.when(F.col("event_id") % 2 == 0, "pii_detection").otherwise("prompt_injection").alias("type"),
        F.when(F.col("event_id") % 3 == 0, "block").when(F.col("event_id") % 3 == 1, "warn").otherwise("allow").alias("action"),
        ((F.col("event_id") % 10) / 10).alias("threshold"),
        F.lit(None).cast("array<string>").alias("patterns"),
    )
    second = F.struct(
        F.lit("prompt_injection").alias("type"), F.lit("block").alias("action"),
        F.when(F.col("event_id") % 5 != 0, F.lit(0.96)).alias("threshold"),
        F.lit(None).cast("array<string>").alias("patterns"),
    )
    op = (
        F.when(F.col("event_type") == "signup", "create").when(F.col("event_type") == "error", "delete")
        .when(F.col("event_type").isin("click", "view"), "update")
    )
    create = F.col("event_type") == "signup"
    return load(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("policy_id"), op.alias("op"), F.unix_micros("ts").alias("ts"),
        F.col("event_id").alias("seq"),
        F.when(create | (F.col("event_type") == "click"), F.concat(F.lit("policy "), F.col("event_id").cast("string"))).alias("name"),
        F.when(F.col("event_type") == "view", F.col("props")).alias("description"),
        F.when(create | (F.col("event_id") % 4 == 0), F.array(rule, second)).alias("rules"),
        F.when(create, F.col("event_id") % 2 == 0).alias("is_default"),
    ).filter("op IS NOT NULL")


_SNAPSHOT = """
log AS (
  SELECT CAST(user_id AS VARCHAR) AS policy_id, epoch_us(ts) AS ts, event_id AS seq,
         CASE event_type WHEN 'signup' THEN 'create' WHEN 'error' THEN 'delete' ELSE 'update' END AS op,
         CASE WHEN event_type IN ('signup', 'click') THEN concat('policy ', event_id) END AS name,
         CASE WHEN event_type = 'view' THEN props END AS description,
         CASE WHEN event_type = 'signup' OR event_id % 4 = 0 THEN event_id END AS rule_src,
         CASE WHEN event_type = 'signup' THEN event_id % 2 = 0 END AS is_default
  FROM events WHERE event_type <> 'purchase'),
gen AS (
  SELECT *, sum((op = 'create')::INT) OVER (PARTITION BY policy_id ORDER BY ts, seq ROWS UNBOUNDED PRECEDING) AS g FROM log),
filled AS (
  SELECT policy_id, g, ts, seq,
         last_value(name IGNORE NULLS) OVER w AS name, last_value(description IGNORE NULLS) OVER w AS description,
         last_value(rule_src IGNORE NULLS) OVER w AS rule_src, last_value(is_default IGNORE NULLS) OVER w AS is_default,
         first_value(ts) OVER w AS created_at,
         sum((op = 'delete')::INT) OVER w AS gone,
         row_number() OVER (PARTITION BY policy_id ORDER BY ts DESC, seq DESC) AS rn
  FROM (SELECT *, CASE WHEN op = 'delete' THEN NULL ELSE 1 END AS x FROM gen) WHERE g > 0
  WINDOW w AS (PARTITION BY policy_id, g ORDER BY ts, seq ROWS UNBOUNDED PRECEDING)),
snapshot AS (
  SELECT policy_id, name, description, is_default, rule_src, created_at, ts AS updated_at FROM filled WHERE rn = 1 AND gone = 0)"""

_RULE_COLUMNS = (
    "CASE WHEN rule_src % 2 = 0 THEN 'pii_detection' ELSE 'prompt_injection' END AS rule_type, "
    "CASE rule_src % 3 WHEN 0 THEN 'block' WHEN 1 THEN 'warn' ELSE 'allow' END AS action, "
    "(rule_src % 10) / 10.0::DOUBLE AS threshold"
)


@query("policy_get", f"WITH {_SNAPSHOT} SELECT policy_id, name, updated_at FROM snapshot WHERE policy_id = '7'")
def policy_get(spark, sf_dir):
    return policy.policy_snapshot(change_log(spark, sf_dir)).filter(F.col("policy_id") == "7").select(
        "policy_id", "name", "updated_at"
    )


def _agents(spark, sf_dir):
    return load(spark, sf_dir, "customer").select(
        F.concat(F.lit("agent-"), F.col("c_custkey").cast("string")).alias("agent_id"),
        F.when(F.col("c_custkey") % 9 != 0, (F.col("c_custkey") % 200).cast("string")).alias("policy_id"),
        F.when(F.col("c_acctbal") > 0, "active").otherwise("inactive").alias("status"),
    )


# each policy of the log has two rules: the varying one and a block above a threshold
_TWO_RULES = f"""
rules AS (
  SELECT policy_id, {_RULE_COLUMNS} FROM snapshot UNION ALL
  SELECT policy_id, 'prompt_injection', 'block', CASE WHEN rule_src % 5 <> 0 THEN 0.96 END FROM snapshot)"""


@query(
    "policy_snapshot",
    f"""WITH {_SNAPSHOT}, {_TWO_RULES}
SELECT policy_id, name, description, is_default, rule_type, action, threshold, created_at, updated_at FROM snapshot JOIN rules USING (policy_id)""",
)
def policy_snapshot(spark, sf_dir):
    """Every rule of every current policy."""
    return policy.policy_snapshot(change_log(spark, sf_dir)).select(
        "policy_id", "name", "description", "is_default", F.explode_outer("rules").alias("r"), "created_at", "updated_at").select(
        "policy_id", "name", "description", "is_default",
        F.col("r.type").alias("rule_type"), F.col("r.action").alias("action"), F.col("r.threshold").alias("threshold"),
        "created_at", "updated_at",
    )


@query(
    "agent_policies",
    f"""WITH {_SNAPSHOT}, {_TWO_RULES}
SELECT agent_id, status, a.policy_id, s.name AS policy_name, r.rule_type, r.action, r.threshold
FROM (SELECT concat('agent-', c_custkey) AS agent_id, CASE WHEN c_custkey % 9 <> 0 THEN CAST(c_custkey % 200 AS VARCHAR) END
        AS policy_id, CASE WHEN c_acctbal > 0 THEN 'active' ELSE 'inactive' END AS status FROM customer) a
LEFT JOIN snapshot s USING (policy_id) LEFT JOIN rules r USING (policy_id)""",
)
def agent_policies(spark, sf_dir):
    return policy.agent_policies(_agents(spark, sf_dir), policy.policy_snapshot(change_log(spark, sf_dir)))


@query(
    "policy_enforce",
    f"""
WITH {_SNAPSHOT}, {_TWO_RULES}, f AS (
  SELECT CAST(doc_id AS VARCHAR) AS request_id, CAST(doc_id % 150 AS VARCHAR) AS policy_id, tt AS threat_type,
         CASE tt WHEN 'prompt_injection' THEN 0.95 ELSE 0.99 END AS score
  FROM (SELECT doc_id, unnest([CASE WHEN contains(lower(content), 'ignore previous') THEN 'prompt_injection' END,
               CASE WHEN contains(content, 'SSN') OR regexp_matches(content, '[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}') THEN 'pii_exposure' END]) AS tt
        FROM (SELECT doc_id, {PROMPT} AS content FROM documents)) WHERE tt IS NOT NULL),
r AS (SELECT policy_id, CASE rule_type WHEN 'pii_detection' THEN 'pii_exposure' ELSE rule_type END AS threat_type,
             CASE action WHEN 'block' THEN 3 WHEN 'warn' THEN 2 ELSE 1 END AS rank, coalesce(threshold, 0) AS threshold FROM rules),
m AS (SELECT f.request_id, f.threat_type, coalesce(max(r.rank), 3) AS rank
      FROM f LEFT JOIN r ON f.policy_id = r.policy_id AND f.threat_type = r.threat_type AND f.score >= r.threshold GROUP BY 1, 2)
SELECT request_id, CASE max(rank) WHEN 3 THEN 'block' WHEN 2 THEN 'warn' ELSE 'allow' END AS action, count(*) AS n_findings
FROM m GROUP BY 1""",
)
def policy_enforce(spark, sf_dir):
    found = scan.findings(prompt_items(spark, sf_dir), "core", kinds=(R.PROMPT,)).select(
        "request_id", (F.col("request_id").cast("bigint") % 150).cast("string").alias("policy_id"),
        X.threat_type(F.col("raw_threat_type")).alias("threat_type"), "confidence_score",
    )
    rules = policy.policy_rules(policy.policy_snapshot(change_log(spark, sf_dir)))
    return policy.enforce_policy(found, rules)


# patterns of the policy of each user; one user in four also has another: one that repeats a group, or a broken one
_WARN_PATTERN = "concat('[aeiou]{', 3 + user_id % 3, '} ')"
_BLOCK_PATTERN = "concat('(one|two|th)[a-z]*', chr(CAST(97 + user_id % 26 AS INT)), 'ing')"
_REPEATED = "(a+)+$"


@query(
    "policy_custom_patterns",
    f"""
WITH u AS (SELECT DISTINCT user_id FROM events),
r AS (SELECT user_id, 2 AS rank, {_WARN_PATTERN} AS pattern FROM u UNION ALL SELECT user_id, 3, {_BLOCK_PATTERN} FROM u
      UNION ALL SELECT user_id, 3, '{_REPEATED}' FROM u WHERE user_id % 12 = 1)
SELECT request_id, policy_id, CASE WHEN max(rank) = 3 THEN 'block' WHEN policy_id::BIGINT % 12 IN (5, 9) THEN 'scan_error' ELSE 'warn' END AS action,
       CAST(CASE WHEN policy_id::BIGINT % 12 IN (5, 9) THEN 1 ELSE 0 END AS BIGINT) AS n_unusable
FROM (SELECT i.request_id, i.policy_id, CASE WHEN regexp_matches(text, pattern) THEN rank END AS rank
      FROM (SELECT CAST(doc_id AS VARCHAR) AS request_id, CAST(doc_id % 150 AS VARCHAR) AS policy_id, text FROM documents) i
      JOIN r ON r.user_id = i.policy_id::BIGINT)
GROUP BY request_id, policy_id HAVING max(rank) IS NOT NULL OR policy_id::BIGINT % 12 IN (5, 9)""",
)
def policy_custom_patterns(spark, sf_dir):
    items = load(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("request_id"), (F.col("doc_id") % 150).cast("string").alias("policy_id"),
        F.col("text").alias("content"),
    )
    policies = load(spark, sf_dir, "events").select("user_id").distinct().select(
        F.col("user_id").cast("string").alias("policy_id"), _custom_rules().alias("rules"))
    return policy.enforce_custom_patterns(items, policies)


def _custom_rules():
    def rule(action, *patterns):
        return F.struct(F.lit("custom").alias("type"), F.lit(action).alias("action"), F.lit(None).cast("double").alias("threshold"),
                        F.array(*patterns).alias("patterns"))

    other = F.when(F.col("user_id") % 12 == 1, F.lit(_REPEATED)).when(F.col("user_id") % 12 == 5, F.lit("[z-a]")).when(
        F.col("user_id") % 12 == 9, F.lit("a{5,2}"))
    return F.array(rule("warn", F.expr(_WARN_PATTERN)), rule("block", F.expr(_BLOCK_PATTERN), F.coalesce(other, F.expr(_BLOCK_PATTERN))))


# classes with escapes, nested groups and groups repeated without bound, as ordinary policies hold them
_SHAPES = (r"[\w.+-]+@[\w-]+", "((th|an)(e|d)?)+ing", r"([aeiou]{2}[^aeiou\s])+ ", r"(?i)(?:ssn|token|(pass|code)(word)?)+\s*[=:]", "(a")


def _shape(number: str) -> str:
    return "['" + "', '".join(_SHAPES) + f"'][CAST(1 + {number} % 5 AS INT)]"


@query(
    "policy_patterns_nested",
    f"""
WITH u AS (SELECT DISTINCT user_id FROM events),
r AS (SELECT user_id, 2 AS rank, {_shape("user_id")} AS pattern FROM u UNION ALL SELECT user_id, 3, {_shape("(user_id // 5)")} FROM u),
b AS (SELECT user_id, count(*) FILTER (pattern = '(a') AS broken FROM r GROUP BY 1),
i AS (SELECT CAST(doc_id AS VARCHAR) AS request_id, doc_id % 150 AS user_id, text FROM documents),
m AS (SELECT request_id, max(CASE WHEN regexp_matches(text, pattern) THEN rank END) AS rank
      FROM i JOIN r USING (user_id) WHERE pattern <> '(a' GROUP BY 1)
SELECT request_id, CAST(user_id AS VARCHAR) AS policy_id, CASE WHEN rank = 3 THEN 'block' WHEN broken > 0 THEN 'scan_error' ELSE 'warn' END AS action,
       CAST(broken AS BIGINT) AS n_unusable
FROM i JOIN b USING (user_id) LEFT JOIN m USING (request_id) WHERE rank IS NOT NULL OR broken > 0""",
)
def policy_patterns_nested(spark, sf_dir):
    items = load(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("request_id"), (F.col("doc_id") % 150).cast("string").alias("policy_id"), F.col("text").alias("content"))
    shapes = F.array(*map(F.lit, _SHAPES))

    def rule(action, at):
        return F.struct(F.lit("custom").alias("type"), F.lit(action).alias("action"), F.lit(None).cast("double").alias("threshold"),
                        F.array(F.get(shapes, at % 5)).alias("patterns"))

    user = F.col("user_id").cast("int")
    policies = load(spark, sf_dir, "events").select("user_id").distinct().select(
        F.col("user_id").cast("string").alias("policy_id"), F.array(rule("warn", user), rule("block", F.floor(user / 5).cast("int"))).alias("rules"))
    return policy.enforce_custom_patterns(items, policies)


@query(
    "policy_decision",
    f"""
WITH {_SNAPSHOT}, {_TWO_RULES}, i AS (
  SELECT CAST(doc_id AS VARCHAR) AS request_id, CAST(doc_id % 150 AS VARCHAR) AS policy_id, {PROMPT} AS content FROM documents),
f AS (
  SELECT request_id, policy_id, tt AS threat_type, CASE tt WHEN 'prompt_injection' THEN 0.95 ELSE 0.99 END AS score
  FROM (SELECT *, unnest([CASE WHEN contains(lower(content), 'ignore previous') THEN 'prompt_injection' END,
               CASE WHEN contains(content, 'SSN') OR regexp_matches(content, '[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}') THEN 'pii_exposure' END]) AS tt
        FROM i) WHERE tt IS NOT NULL),
r AS (SELECT policy_id, CASE rule_type WHEN 'pii_detection' THEN 'pii_exposure' ELSE rule_type END AS threat_type,
             CASE action WHEN 'block' THEN 4 WHEN 'warn' THEN 2 ELSE 1 END AS rank, coalesce(threshold, 0) AS threshold FROM rules),
m AS (SELECT f.request_id, f.threat_type, coalesce(max(r.rank), 4) AS rank
      FROM f LEFT JOIN r ON f.policy_id = r.policy_id AND f.threat_type = r.threat_type AND f.score >= r.threshold GROUP BY 1, 2),
t AS (SELECT request_id, max(rank) AS rank, count(*) AS n FROM m GROUP BY 1),
p AS (SELECT policy_id, CAST(policy_id AS BIGINT) AS user_id FROM snapshot),
c AS (SELECT request_id, CASE WHEN regexp_matches(content, {_BLOCK_PATTERN}) OR user_id % 12 = 1 AND regexp_matches(content, '{_REPEATED}') THEN 4
             WHEN user_id % 12 IN (5, 9) THEN 3 WHEN regexp_matches(content, {_WARN_PATTERN}) THEN 2 END AS rank,
             CASE WHEN user_id % 12 IN (5, 9) THEN 1 ELSE 0 END AS u
      FROM i JOIN p USING (policy_id))
SELECT request_id, ['allow', 'warn', 'scan_error', 'block'][greatest(1, coalesce(t.rank, 1), coalesce(c.rank, 1))] AS action,
       CAST(coalesce(t.n, 0) AS BIGINT) AS n_findings, CAST(coalesce(c.u, 0) AS BIGINT) AS n_unusable
FROM i LEFT JOIN t USING (request_id) LEFT JOIN c USING (request_id)""",
)
def policy_decision(spark, sf_dir):
    items = prompt_items(spark, sf_dir)
    found = scan.findings(items, "core", kinds=(R.PROMPT,)).select(
        "request_id", X.threat_type(F.col("raw_threat_type")).alias("threat_type"), "confidence_score")
    policies = policy.policy_snapshot(change_log(spark, sf_dir)).withColumn("user_id", F.col("policy_id").cast("bigint"))
    policies = policies.withColumn("rules", F.concat("rules", _custom_rules()))
    requests = items.select("request_id", (F.col("request_id").cast("bigint") % 150).cast("string").alias("policy_id"), "content")
    return policy.policy_decision(requests, found, policies)


# --- approvals and agents ----------------------------------------------------
@query(
    "approval_interval_join",
    f"""
WITH a AS (SELECT event_id, user_id, {US} AS b, {US} + (event_id % 20) * 6 * 3600 * 1000000 AS e FROM events WHERE event_type = 'signup'),
     q AS (SELECT event_id, user_id, {US} AS t FROM events WHERE event_type <> 'signup'),
     m AS (SELECT q.event_id, q.user_id, q.t, max(a.e) AS e, arg_max(a.event_id, (a.e, CAST(a.event_id AS VARCHAR))) AS id
           FROM q LEFT JOIN a ON a.user_id = q.user_id AND a.b <= q.t GROUP BY ALL)
SELECT CAST(event_id AS VARCHAR) AS request_id, user_id AS agent_id, coalesce(e > t, FALSE) AS covered,
       CASE WHEN e > t THEN CAST(id AS VARCHAR) END AS approval_id FROM m""",
)
def approval_interval_join(spark, sf_dir):
    events = load(spark, sf_dir, "events").withColumn("at_us", F.unix_micros("ts"))
    granted = events.filter("event_type = 'signup'").select(
        F.col("event_id").cast("string").alias("approval_id"), F.col("user_id").alias("agent_id"),
        F.col("at_us").alias("created_us"), ((F.col("event_id") % 20) * 6 * 3600).alias("expires_in_seconds"),
    )
    asked = events.filter("event_type <> 'signup'").select(
        F.col("event_id").cast("string").alias("request_id"), F.col("user_id").alias("agent_id"), "at_us"
    )
    return approvals.covering_approval(asked, granted)


@query(
    "approvals_pending",
    "SELECT concat('a', event_id) AS approval_id, 'manager' AS approval_level, 600::BIGINT AS expires_in_seconds "
    "FROM events WHERE event_id % 16 = 15 AND event_id % 3 <> 0",
)
def approvals_pending(spark, sf_dir):
    done = verdicts.sanitize_verdicts(_raw(spark, sf_dir))
    granted = load(spark, sf_dir, "events").filter("event_id % 3 = 0").select(
        F.concat(F.lit("a"), F.col("event_id").cast("string")).alias("approval_id")
    )
    return approvals.pending_approvals(done, granted).select("approval_id", "approval_level", "expires_in_seconds")


_NOW_US = 1_706_659_200_000_000  # 2024-01-31 00:00 UTC


@query(
    "agent_liveness",
    f"""
SELECT user_id AS agent_id, max({US}) AS last_heartbeat_us, count(*) AS n_heartbeats,
       CASE WHEN {_NOW_US} - max({US}) <= 86400000000 THEN 'active' ELSE 'inactive' END AS status
FROM events GROUP BY user_id HAVING arg_max(event_type, ({US}, event_type = 'error')) <> 'error'""",
)
def agent_liveness(spark, sf_dir):
    beats = load(spark, sf_dir, "events").select(
        F.col("user_id").alias("agent_id"), F.unix_micros("ts").alias("at_us"),
        (F.col("event_type") == "error").alias("deleted"),
    )
    return agents.agent_liveness(beats, F.lit(_NOW_US), deleted="deleted", after_us=86_400_000_000)


# --- metering ----------------------------------------------------------------
def requests_log(spark, sf_dir):
    """Events as a request log: one key per user, clicks are sandbox calls."""
    return load(spark, sf_dir, "events").select(
        F.col("event_id").alias("request_id"), F.concat(F.lit("k"), F.col("user_id").cast("string")).alias("api_key"), "ts",
        F.when(F.col("event_type") == "click", "sandbox").otherwise("production").alias("mode"), "user_id",
    )


_TIER = "CASE user_id % 4 WHEN 1 THEN 'community' WHEN 2 THEN 'pro' WHEN 3 THEN 'enterprise' END"


@query(
    "monthly_usage",
    f"""
SELECT concat('k', user_id) AS api_key, strftime(ts, '%Y-%m') AS month, count(*) AS n_scans, {_TIER} AS tier,
       CAST(CASE user_id % 4 WHEN 1 THEN 1000 WHEN 2 THEN 25000 WHEN 3 THEN 1000000 END AS BIGINT) AS quota,
       coalesce(count(*) > CASE user_id % 4 WHEN 1 THEN 1000 WHEN 2 THEN 25000 WHEN 3 THEN 1000000 END, FALSE) AS over_quota
FROM events WHERE event_type <> 'click' GROUP BY user_id, 2""",
)
def monthly_usage(spark, sf_dir):
    log = requests_log(spark, sf_dir)
    tiers = log.select("api_key", F.expr(_TIER).alias("tier")).distinct()
    return metering.monthly_usage(log, tiers)


@query(
    "quota_rows",
    """
SELECT event_id AS request_id, concat('k', user_id) AS api_key, strftime(ts, '%Y-%m') AS month,
       coalesce(row_number() OVER (PARTITION BY user_id, strftime(ts, '%Y-%m') ORDER BY ts, event_id)
                > CASE WHEN user_id % 4 <> 0 THEN 10 + user_id % 50 END, FALSE) AS over_quota
FROM events WHERE event_type <> 'click'""",
)
def quota_rows(spark, sf_dir):
    quota = F.when(F.col("user_id") % 4 != 0, 10 + F.col("user_id") % 50)
    return metering.quota_rows(requests_log(spark, sf_dir), quota)


_BUCKET_SQL = """
WITH RECURSIVE e AS (
  SELECT event_id, event_type AS api_key, CAST({rpm} AS BIGINT) AS rpm, (epoch_us(ts) // 1000) // {squeeze} AS ms,
         row_number() OVER (PARTITION BY event_type ORDER BY (epoch_us(ts) // 1000) // {squeeze}, event_id) AS rn FROM events),
b AS (
  SELECT event_id, api_key, rpm, ms, rn, rpm * 60000 AS before FROM e WHERE rn = 1
  UNION ALL
  SELECT e.event_id, e.api_key, e.rpm, e.ms, e.rn,
         least(e.rpm * 60000, CASE WHEN b.before >= 60000 THEN b.before - 60000 ELSE b.before END + (e.ms - b.ms) * e.rpm)
  FROM b JOIN e ON e.api_key = b.api_key AND e.rn = b.rn + 1)
SELECT event_id AS request_id, api_key, ms, before >= 60000 AS allowed,
       CASE WHEN before >= 60000 THEN (before - 60000) // 60000 ELSE 0 END AS remaining,
       CASE WHEN before < 60000 THEN (60000 - before + rpm - 1) // rpm END AS retry_after_ms
FROM b"""


def squeezed_log(spark, sf_dir, squeeze):
    """Events with a faster clock, so that limits are hit; keyed by event type."""
    return load(spark, sf_dir, "events").select(
        F.col("event_id").alias("request_id"), F.col("event_type").alias("api_key"),
        F.floor(epoch_ms(F.col("ts")) / F.lit(squeeze)).alias("ms"),
    )


@query("token_bucket", _BUCKET_SQL.format(rpm="10", squeeze=1000))
def token_bucket(spark, sf_dir):
    return metering.token_bucket(squeezed_log(spark, sf_dir, 1000), rpm=10)


@query("token_bucket_busy", _BUCKET_SQL.format(rpm="50", squeeze=1000))
def token_bucket_busy(spark, sf_dir):
    """Keys that are never silent for a minute, at a rate that they mostly meet."""
    return metering.token_bucket(squeezed_log(spark, sf_dir, 1000), rpm=50)


@query(
    "token_bucket_tiers",
    _BUCKET_SQL.format(rpm="CASE event_type WHEN 'view' THEN 10 WHEN 'click' THEN 100 ELSE 1000 END", squeeze=500_000),
)
def token_bucket_tiers(spark, sf_dir):
    tier = F.when(F.col("api_key") == "view", "community").when(F.col("api_key") == "click", "pro").otherwise("enterprise")
    rpm = X.literal_map(metering.TIER_RPM)[tier]
    return metering.token_bucket(squeezed_log(spark, sf_dir, 500_000), rpm=rpm)


@query(
    "token_bucket_callers",
    """
SELECT event_id AS request_id, event_type AS api_key,
       CASE WHEN event_id % 7 = 3 THEN NULL WHEN event_type = 'view' THEN TRUE WHEN event_type = 'click' THEN FALSE
            ELSE row_number() OVER (PARTITION BY event_type, event_id % 7 = 3 ORDER BY lpad(event_id::VARCHAR, 12, '0')) <= 10 END AS allowed
FROM events""",
)
def token_bucket_callers(spark, sf_dir):
    """Callers without a limit, callers barred, and text ids in one moment; the sandbox takes no token."""
    log = load(spark, sf_dir, "events").select(
        F.col("event_id").alias("n"), F.lpad(F.col("event_id").cast("string"), 12, "0").alias("request_id"), F.col("event_type").alias("api_key"),
        F.lit(0).alias("ms"), F.when(F.col("event_id") % 7 == 3, "sandbox").alias("mode"))
    rate = F.when(F.col("api_key") == "click", 0).when(F.col("api_key") != "view", 10)
    return metering.token_bucket(log, rpm=rate).select(F.col("n").alias("request_id"), "api_key", "allowed")


# --- sessions ----------------------------------------------------------------
_SESSIONS = f"""
SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY us, event_id ROWS UNBOUNDED PRECEDING) AS session_no
FROM (SELECT event_id, user_id, {US} AS us,
        CASE WHEN {US} - lag({US}) OVER (PARTITION BY user_id ORDER BY {US}, event_id) <= 1800000000 THEN 0 ELSE 1 END AS s
      FROM events)"""


def _clocked(spark, sf_dir):
    return load(spark, sf_dir, "events").select("event_id", "user_id", F.unix_micros("ts").alias("us"))


@query(
    "sessionize",
    f"SELECT user_id, session_no::BIGINT AS session_no, min(us) AS first_us, max(us) AS last_us, count(*) AS n_events "
    f"FROM ({_SESSIONS}) GROUP BY ALL",
)
def sessionize(spark, sf_dir):
    return sessions.sessionize(_clocked(spark, sf_dir), "user_id", "us")


@query("session_assignment", f"SELECT event_id, user_id, us, session_no::BIGINT AS session_no FROM ({_SESSIONS})")
def session_assignment(spark, sf_dir):
    return sessions.assign_sessions(_clocked(spark, sf_dir), "user_id", "us")


_SESSION_TEXT = "CASE WHEN doc_id % 10 IN (3, 5) AND doc_id % 20 < 10 THEN concat('Ignore previous  SSN ', doc_id % 100) ELSE " + PROMPT + " END"


def session_verdicts(spark, sf_dir):
    """Prompts in 50 sessions, some sent twice, scanned by the core rules."""
    docs = load(spark, sf_dir, "documents")
    items = I.build_items(docs, R.PROMPT, F.expr(_SESSION_TEXT), request_id=F.col("doc_id").cast("string"),
                          session_id=(F.col("doc_id") % 50).cast("string"))
    done = scan.guard_items(items, kinds=(R.PROMPT,))
    return done.select("session_id", F.col("request_id").cast("bigint").alias("clock"), "safe", "threat_type", "severity",
                       sessions.text_digest(F.col("content")).alias("digest"))


_SESSION_SQL = f"""
v AS (SELECT CAST(doc_id % 50 AS VARCHAR) AS session_id, doc_id AS clock, {CORE_TEXT} AS tt,
        sha256(lower(regexp_replace(content, '[ \\t\\n\\r]+', ' ', 'g'))) AS digest
      FROM (SELECT doc_id, {_SESSION_TEXT} AS content FROM documents))"""


@query(
    "session_risk",
    f"""WITH {_SESSION_SQL}
SELECT session_id, count(*) AS n_requests, count(tt) AS n_unsafe,
       round(1 - exp(coalesce(sum(ln(1 - 0.3)) FILTER (WHERE tt IS NOT NULL), 0)), 6) AS session_risk_score
FROM v GROUP BY 1""",
)
def session_risk(spark, sf_dir):
    return sessions.session_risk(session_verdicts(spark, sf_dir))


@query(
    "session_patterns",
    f"""WITH {_SESSION_SQL},
hit AS (
  SELECT session_id, 'repeat_offender' AS pattern_id FROM v GROUP BY 1 HAVING count(tt) >= 3
  UNION ALL SELECT session_id, 'probing' FROM v GROUP BY 1 HAVING count(DISTINCT tt) >= 2
  UNION ALL SELECT DISTINCT session_id, 'replay' FROM (
    SELECT session_id, lag(tt) OVER (PARTITION BY session_id, digest ORDER BY clock) AS prev FROM v) WHERE prev IS NOT NULL)
SELECT session_id, pattern_id, pattern_name, category, confidence::DOUBLE AS confidence, description
FROM hit JOIN (VALUES {values_rows(sessions.PATTERNS)}) p(pattern_id, pattern_name, category, confidence, description) USING (pattern_id)""",
)
def session_patterns(spark, sf_dir):
    return sessions.session_patterns(session_verdicts(spark, sf_dir))
