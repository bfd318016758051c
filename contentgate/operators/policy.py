"""Policies: the current state of a change log, assignment to agents, enforcement."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contentgate.functions.patterns import compiled, matches

# Rule types that go by another name than the threat they govern.
RULE_THREATS = {"pii_detection": "pii_exposure"}
ACTIONS = {"allow": 1, "warn": 2, "block": 3}


def policy_snapshot(changes: DataFrame, key: str = "policy_id", clock: tuple[str, ...] = ("ts", "seq"),
                    fields: tuple[str, ...] = ("name", "description", "rules", "is_default")) -> DataFrame:
    """Current policies from a log of create, update and delete entries.

    An update sets the fields it gives (NULL means not given). A create sets every field,
    given or not, so nothing of an earlier policy of the same id can show through; entries
    before a create are overruled by it. A policy exists while its last create is later
    than its last delete. One aggregate with a map-side part: no window, no self-join.
    """
    at = F.struct(*[F.col(c) for c in clock])
    creates = F.col("op") == "create"
    updates = F.col("op") == "update"

    def latest(name: str) -> Column:
        is_set = creates | (updates & F.col(name).isNotNull())
        return F.max_by(F.struct(F.col(name).alias("v")), F.when(is_set, at))

    current = changes.groupBy(key).agg(
        F.max(F.when(creates, at)).alias("_created"),
        F.max(F.when(F.col("op") == "delete", at)).alias("_deleted"),
        F.max(F.when(creates | updates, at)).alias("_updated"),
        *[latest(name).alias(f"_{name}") for name in fields],
    )
    alive = F.col("_created").isNotNull() & (F.col("_deleted").isNull() | (F.col("_created") > F.col("_deleted")))
    first = clock[0]
    return current.filter(alive).select(
        key,
        *[F.col(f"_{name}.v").alias(name) for name in fields],
        F.col(f"_created.{first}").alias("created_at"),
        F.col(f"_updated.{first}").alias("updated_at"),
    )


def policy_rules(policies: DataFrame) -> DataFrame:
    """One row per rule; policies without rules keep one row without a rule type."""
    return policies.select("policy_id", F.explode_outer("rules").alias("r")).select(
        "policy_id",
        F.col("r.type").alias("rule_type"),
        F.col("r.action").alias("action"),
        F.col("r.threshold").alias("threshold"),
        F.col("r.patterns").alias("patterns"),
    )


def agent_policies(agents: DataFrame, policies: DataFrame) -> DataFrame:
    """Agents with the rules of their policy; agents without one keep an empty row.

    No broadcast hint: Spark broadcasts the policies only while their size allows, and
    splits a policy that very many agents share otherwise. Rules are exploded afterwards,
    so the join moves one row per agent.
    """
    assigned = agents.select("agent_id", "policy_id", "status").join(
        policies.select("policy_id", F.col("name").alias("policy_name"), "rules"), "policy_id", "left"
    )
    return assigned.select("agent_id", "status", "policy_id", "policy_name", F.explode_outer("rules").alias("r")).select(
        "agent_id", "status", "policy_id", "policy_name",
        F.col("r.type").alias("rule_type"), F.col("r.action").alias("action"), F.col("r.threshold").alias("threshold"),
    )


def action_name(rank: Column) -> Column:
    chain = None
    for name, value in ACTIONS.items():
        chain = F.when(rank == value, F.lit(name)) if chain is None else chain.when(rank == value, F.lit(name))
    return chain


def enforce_policy(findings: DataFrame, rules: DataFrame) -> DataFrame:
    """The action for each request: block over warn over allow.

    Reads findings (request_id, policy_id, threat_type, confidence_score) and rules
    (policy_id, rule_type, action, threshold). A rule matches from its threshold on (none
    = 0); a finding no rule matches is blocked.

    Of all rules for one policy and threat only the lowest threshold of each action counts,
    so rules are reduced to one row per (policy, threat) and the join never multiplies
    findings, however many rules a policy has.
    """
    governed = F.col("rule_type")
    for rule_type, threat in RULE_THREATS.items():
        governed = F.when(F.col("rule_type") == rule_type, F.lit(threat)).otherwise(governed)
    floors = (
        rules.filter(F.col("rule_type") != "custom")
        .groupBy("policy_id", governed.alias("threat_type"))
        .agg(*[
            F.min(F.when(F.col("action") == name, F.coalesce(F.col("threshold"), F.lit(0.0)))).alias(f"_{name}")
            for name in ACTIONS
        ])
    )
    score = F.coalesce(F.col("confidence_score"), F.lit(0.0))
    rank = (
        F.when(score >= F.col("_block"), ACTIONS["block"])
        .when(score >= F.col("_warn"), ACTIONS["warn"])
        .when(score >= F.col("_allow"), ACTIONS["allow"])
        .otherwise(ACTIONS["block"])
    )
    judged = findings.select("request_id", "policy_id", "threat_type", "confidence_score").join(
        floors, ["policy_id", "threat_type"], "left"
    )
    return judged.groupBy("request_id").agg(F.max(rank).alias("_rank"), F.count(F.lit(1)).alias("n_findings")).select(
        "request_id", action_name(F.col("_rank")).alias("action"), "n_findings"
    )


def enforce_custom_patterns(items: DataFrame, policies: DataFrame) -> DataFrame:
    """The strongest custom action whose patterns match the content, per item.

    Patterns stay in the row of the policy: an item joins its one policy and tests that policy's patterns in place, so
    items and patterns are never paired up in a table. Texts go to Arrow in batches; the patterns of a policy and action
    are one automaton, compiled once per task (see ``functions.patterns``), so neither nesting nor repetition in a pattern
    can stall the job, and none can end it.

    Items that no pattern matches are not in the result, unless some pattern could not decide (``n_unusable``: patterns of
    the policy that cannot be read, and patterns with look-around or back references that ran out of time on this
    text): such an item is blocked if another pattern blocks it and is a scan_error otherwise, for the fail mode to resolve.
    """
    custom = F.filter("rules", lambda r: r["type"] == "custom")

    def of_action(action: str) -> Column:
        chosen = F.filter(custom, lambda r: r["action"] == action)
        return F.flatten(F.transform(chosen, lambda r: F.coalesce(r["patterns"], F.array().cast("array<string>")))).alias(action)

    sets = F.struct(*[of_action(name) for name in ACTIONS])
    held = policies.select("policy_id", sets.alias("_sets")).filter(" OR ".join(f"size(_sets.{name}) > 0" for name in ACTIONS))
    held = held.select("policy_id", F.to_json("_sets").alias("_sets"))
    strongest = sorted(ACTIONS, key=ACTIONS.get, reverse=True)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ranks, unusable = [0] * batch.num_rows, [0] * batch.num_rows
            names = batch.column(3).dictionary_encode()
            owner = names.indices.to_numpy()
            for k, text in enumerate(names.dictionary.to_pylist()):
                rows = np.flatnonzero(owner == k)
                texts, groups = batch.column(2).take(pa.array(rows)), json.loads(text)
                for action in strongest:
                    patterns = compiled(tuple(groups.get(action) or ()))
                    found, late = matches(texts, patterns)
                    for row, hit, n in zip(rows.tolist(), found, late):
                        unusable[row] += n + patterns.broken
                        if hit and not ranks[row]:
                            ranks[row] = ACTIONS[action]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(ranks, pa.int32()), pa.array(unusable, pa.int64())],
                names=["request_id", "policy_id", "_rank", "n_unusable"])

    kinds = {name: items.schema[name].dataType.simpleString() for name in ("request_id", "policy_id")}
    judged = items.select("request_id", "policy_id", F.col("content").cast("string").alias("content")).join(held, "policy_id").select(
        "request_id", "policy_id", "content", "_sets").mapInArrow(
        judge, f"request_id {kinds['request_id']}, policy_id {kinds['policy_id']}, _rank int, n_unusable bigint")
    undecided = (F.col("n_unusable") > 0) & (F.col("_rank") < ACTIONS["block"])
    return judged.filter("_rank > 0 OR n_unusable > 0").select(
        "request_id", "policy_id", F.when(undecided, "scan_error").otherwise(action_name(F.col("_rank"))).alias("action"), "n_unusable")


# an undecided request is stopped before a warned one
DECISIONS = {"allow": 1, "warn": 2, "scan_error": 3, "block": 4}


def policy_decision(items: DataFrame, findings: DataFrame, policies: DataFrame) -> DataFrame:
    """One action for every request, typed and custom rules together: block over scan_error over warn over allow.

    Reads items (request_id, policy_id, content), findings (request_id, threat_type, confidence_score) and policies
    (policy_id, rules). A finding is judged under the policy of its request, and blocked where that has no rule for it;
    a request without findings that no pattern matches is allowed. Rows of one request are decided together. Findings
    of a request without an id cannot be attributed, so each such row is a scan_error.

    ``n_findings`` counts the request's findings and ``n_unusable`` its policy's patterns that cannot be run. Each side
    is reduced to small rows first; one aggregate by request, with a map-side part, joins them.
    """
    known = items.filter(F.col("request_id").isNotNull())
    held = known.groupBy("request_id").agg(F.collect_set("policy_id").alias("_policies"))
    judged = findings.select("request_id", "threat_type", "confidence_score").join(held, "request_id").withColumn(
        "policy_id", F.explode_outer("_policies"))
    zero = F.lit(0).cast("bigint")
    parts = (
        known.select("request_id", F.lit("allow").alias("action"), zero.alias("n_findings"), zero.alias("n_unusable"))
        .unionByName(enforce_policy(judged, policy_rules(policies)).withColumn("n_unusable", zero))
        .unionByName(enforce_custom_patterns(known, policies).select("request_id", "action", zero.alias("n_findings"), "n_unusable"))
    )
    rank = F.element_at(F.create_map(*[F.lit(x) for pair in DECISIONS.items() for x in pair]), F.col("action"))
    decided = parts.groupBy("request_id").agg(
        F.max_by("action", rank).alias("action"), F.max("n_findings").alias("n_findings"), F.max("n_unusable").alias("n_unusable"))
    unknown = items.filter(F.col("request_id").isNull()).select(
        "request_id", F.lit("scan_error").alias("action"), zero.alias("n_findings"), zero.alias("n_unusable"))
    return decided.unionByName(unknown)
