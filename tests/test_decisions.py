"""Nothing passes undecided, and nobody is merged with a stranger."""

import json
import random
import re

from pyspark.sql import functions as F

from contentgate.functions import rules as R
from contentgate.operators import extract, gates, policy, scan, verdicts
from contentgate.sources.chat import explode_requests
from contentgate.streaming import gate


def test_kinds_that_are_not_scanned_are_errors(spark):
    df = spark.createDataFrame(
        [("1", R.PROMPT, "hi"), ("2", R.A2A, "ignore previous"), ("3", "letter", "x"), ("4", None, "x")], "request_id string, content_kind string, content string")
    df = df.withColumn("body", F.lit(None).cast("string"))
    got = {r.request_id: (r.outcome, r.safe) for r in gates.gate(scan.guard_items(df, kinds=(R.PROMPT,))).collect()}
    assert got == {"1": ("allowed", True), "2": ("scan_error", None), "3": ("scan_error", None), "4": ("scan_error", None)}
    assert {r.request_id: r.safe for r in scan.scan(df, kinds=(R.PROMPT,)).collect()}["2"] is None


def test_guard_profile_scans_long_prompts_and_speaks_its_dialect(spark):
    df = spark.createDataFrame([("1", "ignore previous " + "x" * 110_000), ("2", " ")], "request_id string, content string")
    df = df.withColumns({"content_kind": F.lit(R.PROMPT), "body": F.lit(None).cast("string")})
    got = {r.request_id: (r.threat_type, r.reason) for r in gate.gated(df, dialect="c", kinds=(R.PROMPT,)).collect()}
    assert got["1"][0] == "prompt_injection" and got["2"] == (None, "No text content to scan")
    client = {r.request_id: r.threat_type for r in scan.guard_items(df, kinds=(R.PROMPT,), profile="client").collect()}
    assert client == {"1": "size_limit_exceeded", "2": None}


def test_patterns_that_cannot_run_leave_an_error_and_end_no_job(spark):
    rules = "array<struct<type:string,action:string,patterns:array<string>>>"
    policies = spark.createDataFrame(
        [("bad", [("custom", "block", ["[z-a]"])]), ("half", [("custom", "block", ["a{5,2}", "bomb"]), ("custom", "warn", ["tick"])]), ("good", [("custom", "warn", ["tick"])]),
         ("null", [("custom", "warn", [None, "tick"])]), ("none", [("custom", "warn", None)])],
        f"policy_id string, rules {rules}")
    items = spark.createDataFrame(
        [("1", "bad", "tick"), ("2", "half", "a bomb"), ("3", "half", "tick"), ("4", "good", "tick"), ("5", "good", "none"), ("6", "null", "tick"),
         ("7", "good", None), ("8", "bad", None), ("9", "none", "tick"), ("10", None, "tick")], "request_id string, policy_id string, content string")
    got = {r.request_id: (r.action, r.n_unusable) for r in policy.enforce_custom_patterns(items, policies).collect()}
    assert got == {"1": ("scan_error", 1), "2": ("block", 1), "3": ("scan_error", 1), "4": ("warn", 0), "6": ("scan_error", 1), "8": ("scan_error", 1)}


def test_patterns_of_any_shape(spark):
    """Nested and repeated groups, classes with escapes, look-around and back references, against a plain matcher."""
    shapes = [r"[\w.+-]+@[\w-]+", "(foo|bar)+baz", "((a|b)(c|d)?)+e", r"(?i)se(cret|sam[ae])\s*[:=]", r"^\s*$", r"\bssn\b", "(?<=id )[0-9]{4,}", r"(['\"])x\1", "a{2}|b{3,}c", "x(y(z(w)?)?)?!"]
    texts = ["me.you+x@host-1", "foobarfoobaz", "acbce", "SECRET :", "sesama=", "   ", "my ssn here", "assn", "id 12345", "id 12", "'x'", "'x\"", "aa", "bbbbc", "xyz!", "x!", "none", ""]
    policies = spark.createDataFrame([(f"p{k}", [("custom", "block", [s])]) for k, s in enumerate(shapes)] + [("all", [("custom", "block", shapes[:3]), ("custom", "warn", shapes[3:])])],
                                     "policy_id string, rules array<struct<type:string,action:string,patterns:array<string>>>")
    items = spark.createDataFrame([(f"{p}:{t}", f"p{p}", text) for p in range(len(shapes)) for t, text in enumerate(texts)]
                                  + [(f"all:{t}", "all", text) for t, text in enumerate(texts)], "request_id string, policy_id string, content string")
    got = {r.request_id: r.action for r in policy.enforce_custom_patterns(items, policies).collect()}
    want = {f"{p}:{t}": "block" for p, s in enumerate(shapes) for t, text in enumerate(texts) if re.search(s, text, re.A)}
    for t, text in enumerate(texts):
        hits = [bool(re.search(s, text, re.A)) for s in shapes]
        if any(hits):
            want[f"all:{t}"] = "block" if any(hits[:3]) else "warn"
    assert got == want


def test_no_pattern_stalls_the_job(spark, monkeypatch):
    """What would backtrack without end is linear, and look-around that would runs out of time and decides nothing."""
    text = "a" * 40_000 + "!"
    policies = spark.createDataFrame(
        [("linear", [("custom", "block", ["(a+)+$", "(a|aa)+$", "(.*)*b"])]), ("slow", [("custom", "warn", [r"(?=(a+)+b)a", "!$"])])],
        "policy_id string, rules array<struct<type:string,action:string,patterns:array<string>>>")
    items = spark.createDataFrame([("1", "linear", text), ("2", "slow", "a" * 40 + "!"), ("3", "slow", "!")], "request_id string, policy_id string, content string")
    got = {r.request_id: (r.action, r.n_unusable) for r in policy.enforce_custom_patterns(items, policies).collect()}
    assert got.get("1") is None and got["3"] == ("warn", 0) and got["2"] in (("warn", 0), ("scan_error", 1))


def test_a_thousand_patterns_are_few_automata():
    from contentgate.functions.patterns import compiled

    some = tuple(f"(word{k}|term{k})+[0-9]{{2}}" for k in range(1000))
    made = compiled((*some, "(broken", *some[:10]))
    assert made.broken == 1 and len(made.automata) <= 32 and not made.backtracking


def test_one_decision_for_every_request(spark):
    rule = "struct<type:string,action:string,threshold:double,patterns:array<string>>"
    policies = spark.createDataFrame(
        [("p", [("pii_detection", "warn", 0.5, None), ("custom", "block", None, ["bomb"])]), ("q", [("custom", "warn", None, ["[z-a]", "tick"])])],
        f"policy_id string, rules array<{rule}>")
    items = spark.createDataFrame(
        [("1", "p", "SSN"), ("2", "p", "SSN bomb"), ("3", "p", "quiet"), ("4", "q", "tick"), ("5", "q", "SSN"), ("6", None, "SSN"), ("7", None, "quiet"),
         ("8", "gone", None), (None, "p", "bomb"), (None, "p", "quiet")], "request_id string, policy_id string, content string")
    found = items.filter("content like 'SSN%'").select("request_id", F.lit("pii_exposure").alias("threat_type"), F.lit(0.9).alias("confidence_score"))
    got = sorted((r.request_id or "", r.action, r.n_findings) for r in policy.policy_decision(items, found, policies).collect())
    assert got == [
        ("", "scan_error", 0), ("", "scan_error", 0), ("1", "warn", 1), ("2", "block", 1), ("3", "allow", 0), ("4", "scan_error", 0),
        ("5", "block", 1), ("6", "block", 1), ("7", "allow", 0), ("8", "allow", 0)]


def test_card_numbers_beside_other_digits(spark):
    cards = ["4111 1111 1111 1111", "4111 1111 1111 1111 12/26", "4111-1111-1111-1111 123", "qty 2 4111 1111 1111 1111", "4111111111111111.",
             "id 7 7 7 378282246310005 9", "a\n4111 1111 1111 1111\nb"]
    others = ["4111 1111 1111 1112", "4111 1111 1111 1112 123", "x4111111111111111", "4111111111111111x", "4111  1111 1111 1111", "4111 1111\n1111 1111",
              "41111111111111110000000", "", "4111 1111 1111 111_", "1" * 12, None]
    df = spark.createDataFrame([(t,) for t in (*cards, *others)], "t string")
    got = {r.t for r in df.filter(R.card_number(F.col("t"))).collect()}
    assert got == set(cards)


def test_text_conversations_and_messages_without_one(spark):
    lines = spark.createDataFrame([('{"conv_id": "u-1", "messages": [{"role": "user", "content": "a"}]}',), ('{"conv_id": "u-2", "messages": [{"role": "user", "content": "b"}]}',)], "value string")
    assert sorted(r.conv_id for r in explode_requests(lines).collect()) == ["u-1", "u-2"]
    turns = spark.createDataFrame(
        [(None, 0, "user", "SSN of mine"), (None, 1, "user", "hello"), ("c", 0, "user", "x"), ("c", 1, "user", "y")], "conv_id string, turn bigint, role string, text string")
    history = {(r.conv_id, r.turn): r.history for r in extract.conversation_history(turns, limit=1_000).collect()}
    assert history == {(None, 0): "", (None, 1): "", ("c", 0): "", ("c", 1): "x"}
    verdicts = sorted((r.conv_id or "", r.n_messages, r.safe) for r in scan.scan_chat(turns).collect())
    assert verdicts == [("", 1, False), ("", 1, True), ("c", 2, True)]
    texts = sorted((r.conv_id or "", r.user_text) for r in extract.extract_user_text(turns).collect())
    assert texts == [("", "SSN of mine"), ("", "hello"), ("c", "x\ny")]


def test_nested_free_form_text_is_read(spark):
    cases = {
        '{"parts":{"parts":{"parts":[{"text":"deep"}]}}}': ("deep", "deep"),
        '[{"parts":[{"parts":[{"text":"hidden"}]}]},{"text":"x"}]': ("x", "hidden\nx"),
        '{"parts":{}}': ("[object Object]", "[object Object]"),
    }
    far = '{"parts":' * 9 + '"t"' + "}" * 9
    df = spark.createDataFrame([(c,) for c in (*cases, far)], "c string").select("c", F.parse_json("c").alias("v"))
    got = {r.c: (r.t, r.d) for r in df.select("c", extract.free_text(F.col("v")).alias("t"), extract.free_text(F.col("v"), deep=True).alias("d")).collect()}
    assert got == {**cases, far: (None, None)}


def slow_free_text(value, deep):
    """The rules of free-form content, read recursively."""
    class Unreadable(Exception):
        pass

    def form(x):
        return x if isinstance(x, str) else None if x in (None, False) or x == 0 else json.dumps(x, separators=(",", ":"))

    def items(parts):
        out = []
        for p in parts:
            if p is None:
                raise Unreadable
            own = p if isinstance(p, str) else form(p.get("text")) or None if isinstance(p, dict) else None
            if own is None and deep and isinstance(p, dict) and isinstance(p.get("parts"), list):
                out += items(p["parts"])
            elif own is not None:
                out.append(own)
        return out

    def read(x):
        if isinstance(x, str):
            return x
        if isinstance(x, list):
            return "\n".join(items(x))
        own = form(x.get("text"))
        if own:
            return own
        parts = x.get("parts")
        if isinstance(parts, list):
            if None in parts:
                raise Unreadable
            return "\n".join(t for p in parts for t in [p if isinstance(p, str) else (form(p.get("text")) or None) if isinstance(p, dict) else None] if t is not None)
        if isinstance(parts, dict):
            return read(parts)
        return form(parts) or "[object Object]"

    try:
        return read(value) if value is not None else None
    except Unreadable:
        return None


def test_free_form_text_at_every_depth(spark):
    rng = random.Random(9)

    def leaf():
        return rng.choice(["a", "", {"text": "b"}, {"text": ""}, {"other": 1}, {"parts": []}, *([None] if rng.random() < 0.1 else [])])

    values = []
    for depth in (*range(1, 9), 13, 14, 50):
        for _ in range(5):
            value = [leaf() for _ in range(rng.randrange(1, 4))]
            for _ in range(depth):
                value = [leaf() for _ in range(rng.randrange(2))] + [{"role": "user", "parts": value}] + [leaf() for _ in range(rng.randrange(2))]
            values.append(value)
            inner = rng.choice([{"text": "t"}, {"parts": ["p", {"text": "q"}]}, {"parts": "s"}, {}, {"parts": [None]}])
            for _ in range(depth):
                inner = {"parts": inner, **({"text": ""} if rng.random() < 0.3 else {})}
            values.append(inner)
    values += ["plain", None, [], {}, [[1]], {"parts": {"text": "x"}}]
    df = spark.createDataFrame([(k, json.dumps(v)) for k, v in enumerate(values)], "k int, j string").select("k", F.parse_json("j").alias("v"))
    for deep in (False, True):
        got = {r.k: r.text for r in extract.extract_free_text(df, "v", deep).collect()}
        assert got == {k: slow_free_text(v, deep) for k, v in enumerate(values)}


def test_leaks_are_found_at_any_depth(spark):
    rows = [
        '{"violations":[{"matched_text":"x"}],"reason":"the \\"policy_id\\": field"}', '{"meta":{"policy_id":1}}',
        '{"approval_info":{"policy_name":"p"}}', '{"approval_info":{"policy_name":"p"},"meta":{"policy_name":"q"}}']
    df = spark.createDataFrame([(r,) for r in rows], "j string").select(F.parse_json("j").alias("raw"))
    got = {r.field: r.n_rows for r in verdicts.leak_audit(df).collect()}
    assert {k: got.get(k) for k in ("matched_text", "policy_id", "policy_name")} == {"matched_text": 1, "policy_id": 1, "policy_name": 1}
