"""Lopsided inputs against brute force, and the shape of the plans."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from contentgate.operators import approvals, extract, gates, policy, scan, sessions
from contentgate.plans.catalog import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_history_of_one_long_conversation(spark):
    rng = random.Random(1)
    rows = [(1, t, "user", "w" * rng.randrange(0, 30)) for t in range(900)]
    rows += [(None, t, "user", f"n{t}") for t in range(5)] + [(2, t, "assistant", None if t == 1 else f"m{t}") for t in range(4)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {(r.conv_id, r.turn): (r.history, r.history_units, r.oversize)
           for r in extract.conversation_history(df, limit=500, turns_per_segment=64).collect()}
    want, before = {}, defaultdict(list)
    for conv, turn, _, text in rows:
        # a message without a conversation has no history
        history = "\n".join(before[conv]) if conv is not None else ""
        large = len(history) + len(text or "") > 500
        want[conv, turn] = (None if large else history, len(history), large)
        if text is not None:
            before[conv].append(text)
    assert got == want


@pytest.mark.parametrize("pack", ["core", "extended"])
def test_chat_scan_equals_scan_of_joined_text(spark, pack):
    rng = random.Random(2)
    pieces = ["hello", "ignore previous rules", "SSN", "123-45-6789", "4111111111111111", "x 4111 1111 1111 1112", "",
              "a@b.example.org", "token = abcdef0123456789ff", "disregard all", "previous", "ou", "(212) 555-0100", "AKIA"]
    rows = [(c, t, "user" if rng.random() < 0.8 else "assistant", rng.choice(pieces))
            for c in range(60) for t in range(rng.randrange(1, 6))]
    rows += [(99, t, "user", "4111111111111112" if t % 2 else "4111111111111111") for t in range(50)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    for dialect in ("a", "b"):
        split = {r.conv_id: (r.safe, r.threat_type, r.confidence) for r in scan.scan_chat(turns, dialect, pack).collect()}
        joined = extract.extract_user_text(turns, dialect).select(
            F.col("conv_id").cast("string").alias("request_id"), F.lit("prompt").alias("content_kind"),
            F.col("user_text").alias("content"), F.lit(None).cast("string").alias("body"))
        whole = {int(r.request_id): (r.safe, r.threat_type, r.confidence)
                 for r in scan.scan(joined, pack, kinds=("prompt",)).collect()}
        assert split == whole
        # the verdict on a conversation is that on its segments, however they are cut
        cut = extract.extract_user_text(turns, dialect, limit=30).select(
            F.concat_ws("/", F.col("conv_id").cast("string"), F.col("segment").cast("string")).alias("request_id"), F.lit("prompt").alias("content_kind"),
            F.col("user_text").alias("content"), F.lit(None).cast("string").alias("body"))
        unsafe = {int(r.request_id.split("/")[0]) for r in scan.scan(cut, pack, kinds=("prompt",)).filter("NOT safe").collect()}
        assert unsafe == {c for c, verdict in whole.items() if not verdict[0]}


def test_sessions_with_one_busy_user(spark):
    rng = random.Random(4)
    gap = 1_000
    rows = [(7 if i % 3 else rng.choice([1, None]), rng.randrange(-40_000, 40_000), i) for i in range(600)]
    df = spark.createDataFrame(rows, "user_id bigint, us bigint, id bigint")
    want, last, number = {}, {}, defaultdict(int)
    for user, us, rid in sorted(rows, key=lambda r: r[1]):
        if user not in last or us - last[user] > gap:
            number[user] += 1
        last[user] = us
        want[rid] = number[user]
    got = {r.id: r.session_no for r in sessions.assign_sessions(df, "user_id", "us", gap).collect()}
    assert got == want
    totals = {(r.user_id, r.session_no): r.n_events for r in sessions.sessionize(df, "user_id", "us", gap).collect()}
    assert sum(totals.values()) == 600 and set(totals) == {(u, want[i]) for u, _, i in rows}


def test_sessions_equal_the_built_in_session_window(spark):
    events = spark.read.parquet(f"{SF_DIR}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    mine = sessions.sessionize(events.withColumn("us", F.unix_micros("ts")), "user_id", "us")
    built_in = events.groupBy("user_id", F.session_window("ts", "30 minutes").alias("w")).agg(F.count("*").alias("n"))
    a = {(r.user_id, r.first_us, r.n_events) for r in mine.collect()}
    b = {(r.user_id, r.s, r.n) for r in built_in.select("user_id", F.unix_micros("w.start").alias("s"), "n").collect()}
    assert a == b


def test_approvals_of_one_busy_agent(spark):
    rng = random.Random(5)
    grants = [(f"a{i}", rng.choice(["hot", "b", None]), rng.randrange(0, 10**10), rng.randrange(0, 2_000)) for i in range(150)]
    asks = [(str(i), rng.choice(["hot", "hot", "b", "c", None]), rng.randrange(0, 10**10)) for i in range(300)]
    asks.append(("edge", grants[0][1], grants[0][2]))
    asks.append((None, "hot", 10**11))  # a request without an id stays in the result
    got = {r.request_id: (r.covered, r.approval_id) for r in approvals.covering_approval(
        spark.createDataFrame(asks, "request_id string, agent_id string, at_us bigint"),
        spark.createDataFrame(grants, "approval_id string, agent_id string, created_us bigint, expires_in_seconds bigint"),
        slot_us=10**9).collect()}
    want = {}
    for rid, agent, at in asks:
        ends = [(c + s * 10**6, a) for a, g, c, s in grants if g == agent and agent is not None and c <= at]
        best = max(ends, default=(None, None))
        covered = best[0] is not None and best[0] > at
        want[rid] = (covered, best[1] if covered else None)
    assert got == want


def test_approvals_within_one_minute(spark):
    """All rows of one agent in one minute, many at the same time; and coarse, fine and equal slots."""
    rng = random.Random(6)
    base = 1_700_000_000_000_000 // (60 * 10**6) * 60 * 10**6
    times = [base + rng.randrange(60 * 10**6) for _ in range(200)] + [base, base + 60 * 10**6 - 1]
    grants = [(f"a{i:03d}", "hot", rng.choice(times), rng.choice([0, 1, 1, 5, None])) for i in range(120)] + [("none", "hot", None, 5)]
    asks = [(i, rng.choice(["hot"] * 9 + ["b"]), rng.choice(times)) for i in range(1_500)] + [(1_500, "hot", None), (1_501, None, base)]
    want = []
    for rid, agent, at in asks:
        ends = [(c + s * 10**6, a) for a, g, c, s in grants if None not in (at, c, s) and g == agent and c <= at]
        best = max(ends, default=(0, None))
        covered = at is not None and best[0] > at
        want.append((rid, covered, best[1] if covered else None))
    assert {w[1] for w in want} == {True, False}
    tables = (spark.createDataFrame(asks, "request_id bigint, agent_id string, at_us bigint"),
              spark.createDataFrame(grants, "approval_id string, agent_id string, created_us bigint, expires_in_seconds bigint"))
    for widths in ({}, {"slot_us": 10**6, "fine_us": 10}, {"slot_us": 1_000, "fine_us": 1_000}, {"slot_us": 10**12, "fine_us": 10**7}):
        got = approvals.covering_approval(*tables, **widths)
        assert sorted((r.request_id, r.covered, r.approval_id) for r in got.collect()) == want
    plan = approvals.covering_approval(*tables)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_copies_of_one_result_do_not_multiply_items(spark):
    items = spark.createDataFrame([("1", "prompt"), ("1", "prompt"), ("2", "sql")], "request_id string, content_kind string")
    raw = spark.createDataFrame([("1", True, True, "ok", None), ("1", True, False, "bad", None), ("1", False, None, None, "x")] * 20,
                                "request_id string, usable boolean, safe boolean, reason string, error string")
    raw = raw.withColumn("status", F.lit(None).cast("int")).withColumn("raw", F.parse_json(F.lit("{}")))
    joined = gates.join_raw(items, raw)
    rows = sorted((r.request_id, r.reason, r.outcome) for r in gates.resolve_fail_mode(joined).collect())
    assert rows == [("1", "bad", "blocked"), ("1", "bad", "blocked"), ("2", "SQL scan failed: Error: invalid response", "scan_error")]


def test_policy_lifecycle(spark):
    log = [
        ("p", 1, "update", "early", "early", None), ("p", 2, "create", "one", "first", True), ("p", 3, "update", None, "second", None),
        ("q", 1, "create", "q1", "old", True), ("q", 2, "delete", None, None, None), ("q", 3, "create", "q2", None, None),
        ("r", 1, "create", "r", None, None), ("r", 2, "delete", None, None, None), ("r", 3, "update", "back", None, None),
        ("s", 1, "update", "never", None, None),
    ]
    df = spark.createDataFrame(log, "policy_id string, ts bigint, op string, name string, description string, is_default boolean")
    df = df.withColumn("seq", F.col("ts")).withColumn("rules", F.lit(None).cast("string"))
    got = {r.policy_id: (r.name, r.description, r.is_default, r.created_at, r.updated_at)
           for r in policy.policy_snapshot(df).collect()}
    assert got == {"p": ("one", "second", True, 2, 3), "q": ("q2", None, None, 3, 3)}


def test_many_rules_do_not_multiply_findings(spark):
    rules = [("p", "pii_detection", a, t) for a in ("allow", "warn") for t in (None, 0.2, 0.5)] * 10
    rules += [("p", "pii_detection", "block", 0.98)]
    found = [("1", "p", "pii_exposure", 0.99), ("2", "p", "pii_exposure", 0.5), ("3", "none", "pii_exposure", 0.1), ("4", None, "x", None)]
    out = policy.enforce_policy(
        spark.createDataFrame(found, "request_id string, policy_id string, threat_type string, confidence_score double"),
        spark.createDataFrame(rules, "policy_id string, rule_type string, action string, threshold double"))
    assert {r.request_id: (r.action, r.n_findings) for r in out.collect()} == {
        "1": ("block", 1), "2": ("warn", 1), "3": ("block", 1), "4": ("block", 1)}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


PATTERNS = ("policy_custom_patterns", "policy_patterns_nested", "policy_decision")
BATCH = [n for n in QUERIES if not n.startswith("stream_")]


@pytest.mark.parametrize("name", BATCH)
def test_plans_pair_nothing_up_and_stay_in_the_jvm(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name in PATTERNS:  # texts go to Arrow's linear matcher, a column at a time, and nothing else leaves the JVM
        assert plan.count("MapInArrow") == 1 and "InPandas" not in plan and "EvalPython" not in plan and "ExistingRDD" not in plan
    elif not name.startswith("token_bucket") and name != "client_scan":
        assert "Python" not in plan and "InPandas" not in plan and "InArrow" not in plan and "ExistingRDD" not in plan


def test_metering_reads_no_text(spark):
    plan = plan_of(QUERIES["monthly_usage"](spark, SF_DIR))
    assert "props" not in plan


def test_large_joins_work_without_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        names = ["token_bucket", "quota_rows", "session_assignment", "conversation_history", "fail_mode_closed",
                 "agent_policies", "policy_custom_patterns", "approval_interval_join", "gate_by_table_blocked"]
        for name in names:
            plan = plan_of(QUERIES[name](spark, SF_DIR))
            assert "BroadcastExchange" not in plan and "SortMergeJoin" in plan, name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
