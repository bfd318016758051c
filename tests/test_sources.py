"""Reading and writing: chat logs, raw results, registries, gated items."""

import json

import pytest
from pyspark.sql import functions as F

from contentgate.operators import gates, scan
from contentgate.session import shared_dir
from contentgate.sources import items as I
from contentgate.sources.chat import read_chat, unreadable_requests
from contentgate.sources.registry import read_agents, read_policies
from contentgate.sources.results import read_gated, read_raw_verdicts, write_gated


def write_lines(path, rows):
    path.write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows))
    return str(path)


def test_chat_from_json_lines(spark, tmp_path):
    path = write_lines(tmp_path / "chat.jsonl", [
        {"conv_id": 1, "messages": [{"role": "user", "content": "a"}, {"role": "user", "content": ["x"]}]}, "{broken",
        {"conv_id": 2, "messages": "none"}])
    rows = read_chat(spark, path, "json").select("conv_id", "turn", "role", F.to_json("content").alias("c")).collect()
    assert [(r.conv_id, r.turn, r.role, r.c) for r in rows] == [("1", 0, "user", '"a"'), ("1", 1, "user", '["x"]')]
    unread = unreadable_requests(spark.read.text(path)).collect()
    assert sorted(r.value for r in unread) == ['{"conv_id": 2, "messages": "none"}', "{broken"]


def test_unreadable_lines_stay_in_one_reading(spark, tmp_path):
    lines = [{"conv_id": 1, "messages": [{"role": "user", "content": "a"}]}, "{broken", {"conv_id": 2, "messages": "none"}, {"conv_id": 3, "messages": []}, "null", ""]
    rows = read_chat(spark, write_lines(tmp_path / "chat.jsonl", lines + [{"conv_id": 4}]), "json", keep_unreadable=True).collect()
    assert [(r.conv_id, r.turn, r.role) for r in rows if r.unreadable is None] == [("1", 0, "user")]
    assert sorted(r.unreadable for r in rows if r.unreadable is not None) == sorted(["", "null", "{broken", json.dumps(lines[2]), json.dumps({"conv_id": 4})])
    assert all(r.conv_id is None and r.turn is None for r in rows if r.unreadable is not None)
    agents = read_agents(spark, write_lines(tmp_path / "a.jsonl", [{"agent_id": "1", "api_key": "clear"}, '{"agent_id": "2", "api_key": "clear']), keep_unreadable=True).collect()
    assert [r.unreadable is None for r in sorted(agents, key=lambda r: r.agent_id or "~")] == [True, False]
    assert "clear" not in str(agents)
    policies = read_policies(spark, write_lines(tmp_path / "p.jsonl", [{"policy_id": "a"}, "nonsense"]), keep_unreadable=True)
    assert sorted((r.policy_id or "", r.unreadable or "") for r in policies.collect()) == [("", "nonsense"), ("a", "")]


def test_raw_results_from_lines(spark, tmp_path):
    path = write_lines(tmp_path / "raw.jsonl", [{"request_id": "1", "safe": False, "threat_type": "pii"}, "null", "{x"])
    rows = read_raw_verdicts(spark, path).select("request_id", "usable", "safe", "threat_type").collect()
    assert sorted(map(tuple, rows), key=repr) == sorted(
        [("1", True, False, "pii"), (None, False, True, None), (None, False, True, None)], key=repr)


def test_registries(spark, tmp_path):
    policies = write_lines(tmp_path / "p.jsonl", [
        {"policy_id": "a", "name": "A", "rules": [{"type": "custom", "action": "warn", "patterns": ["x"], "extra": 1}]},
        {"policy_id": "b", "name": "B", "rules": []}])
    assert [r.name for r in read_policies(spark, policies, "b").collect()] == ["B"]
    assert read_policies(spark, policies).filter("policy_id = 'a'").first().rules[0].patterns == ["x"]
    agents = write_lines(tmp_path / "a.jsonl", [{"agent_id": "1", "api_key": "clear", "policy_id": "a"}])
    assert read_agents(spark, agents, "1").first().api_key != "clear"


def test_gated_table_is_complete_and_pruned(spark, tmp_path):
    df = spark.createDataFrame([("1", "prompt", "hi", None), ("2", "prompt", "SSN", None), ("3", "sql", "DROP TABLE x", None)],
                               "request_id string, content_kind string, content string, body string")
    write_gated(gates.gate(scan.guard_items(df)), str(tmp_path / "g"))
    allowed, blocked = read_gated(spark, str(tmp_path / "g")), read_gated(spark, str(tmp_path / "g"), allowed=False)
    assert [r.request_id for r in allowed.collect()] == ["1"]
    assert sorted(r.request_id for r in blocked.collect()) == ["2", "3"]
    assert "PartitionFilters: [isnotnull(outcome" in allowed._jdf.queryExecution().executedPlan().toString()


def test_items_reject_unknown_names(spark):
    df = spark.range(1)
    with pytest.raises(ValueError):
        I.build_items(df, "letter", F.lit("x"))
    with pytest.raises(ValueError):
        I.build_items(df, "prompt", F.lit("x"), colour=F.lit("x"))


def test_request_ids_do_not_change_between_runs(spark):
    df = I.build_items(spark.range(100), "prompt", F.col("id").cast("string"))
    assert df.select("request_id").collect() == df.repartition(7).orderBy(F.col("content").cast("int")).select("request_id").collect()


def test_shared_folder_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark).startswith(root)


def test_two_callers_with_one_text_have_two_ids(spark):
    df = spark.createDataFrame([("a", "t"), ("b", "t")], "k string, t string")
    assert I.build_items(df, "prompt", F.col("t"), api_key=F.col("k")).select("request_id").distinct().count() == 2
    nothing = F.lit(None).cast("string")
    pair = spark.range(1).select(
        I.request_id(nothing, F.lit("a,b"), F.lit("c")).alias("x"), I.request_id(nothing, F.lit("a"), F.lit("b,c")).alias("y"),
        I.request_id(nothing, F.lit(""), nothing).alias("z"), I.request_id(nothing, nothing, F.lit("")).alias("w")).first()
    assert len(set(pair)) == 4
