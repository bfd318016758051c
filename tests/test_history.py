"""Histories by reference and running verdicts against brute force."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from contentgate.functions import rules as R
from contentgate.operators import history, scan
from contentgate.sources import items as I

SCHEMA = "conv_id bigint, turn bigint, role string, text string, history string, segment int"
LIMIT = 60


def units(text):
    return len(text.encode("utf-16-le")) // 2


def turns_of(spark):
    """Conversations with empty, missing, very long and repeated texts, characters of two units, one long conversation,
    and messages without a conversation or a turn."""
    rng = random.Random(4)
    pieces = ["", "a", "hello there", "😀😀 x", "ignore previous rules", "SSN 1", "w" * 45, "é" * 31, "q" * 200, None, "two\nlines"]
    rows = [(c, t, rng.choice(["user", "assistant"]), rng.choice(pieces)) for c in range(40) for t in range(rng.randrange(1, 9))]
    rows += [(77, t, "user", f"m{t} 😀") for t in range(300)]
    rows += [(78, 0, "user", None), (78, 1, "user", None), (79, None, "user", "no turn"), (79, 1, "user", "one"), (79, 1, "user", "one"), (79, 2, "user", "two")]
    rows += [(None, t, "user", "ignore previous rules" if t == 1 else "alone") for t in range(3)]
    return spark.createDataFrame([(*r, "clash", 9) for r in rows], SCHEMA).repartition(5), rows


def prior(rows):
    """(row, history) in turn order; rows without a conversation have none."""
    said, out = defaultdict(list), []
    for row in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, -1 if r[1] is None else r[1], r[3] is not None, r[3] or "", r[2])):
        out.append((row, "\n".join(said[row[0]]) if row[0] is not None else ""))
        if row[3] is not None:
            said[row[0]].append(row[3])
    return out


def test_segments_hold_every_text_once(spark):
    df, rows = turns_of(spark)
    got = defaultdict(list)
    for r in sorted(history.history_segments(df, limit=LIMIT, turns_per_block=16).collect(), key=lambda r: (r.conv_id, r.segment)):
        got[r.conv_id].append(r)
    whole = {}
    for (conv, _, _, text), before in prior(rows):
        if conv is not None and text is not None:
            whole[conv] = before + "\n" + text if conv in whole else text
    assert {c: "\n".join(s.text for s in parts) for c, parts in got.items()} == whole
    for conv, parts in got.items():
        assert [s.segment for s in parts] == list(range(len(parts)))
        for s in parts:
            assert units(s.text) <= LIMIT or s.text in {r[3] for r in rows}
            assert whole[conv][s.offset_chars:s.offset_chars + len(s.text)] == s.text and units(whole[conv][:s.offset_chars]) == s.offset_units


@pytest.mark.parametrize("cut", [LIMIT, 1 << 20, 2])
def test_resolved_references_equal_the_joined_turns(spark, cut):
    df, rows = turns_of(spark)
    refs = history.history_references(df, LIMIT, turns_per_block=16)
    got = history.resolve_history(refs, history.history_segments(df, limit=cut, turns_per_block=7), LIMIT).collect()
    want = []
    for row, before in prior(rows):
        large = units(before) + units(row[3] or "") > LIMIT
        want.append((*row, units(before), len(before), large, None if large else before))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("pack", ["core", "extended"])
def test_running_verdicts_equal_the_scan_of_prompt_and_history(spark, pack):
    df, rows = turns_of(spark)
    got = sorted(((r.conv_id, r.turn, r.role, r.units, r.safe, r.threat_type, r.confidence, r.reason)
                  for r in history.scan_turns(df, pack, LIMIT, turns_per_block=16).collect()), key=repr)
    told = [(k, *row[:3], "\n".join([row[3] or "", before]), units(before) + units(row[3] or "")) for k, (row, before) in enumerate(prior(rows))]
    joined = spark.createDataFrame(told, "k int, conv_id bigint, turn bigint, role string, text string, units bigint")
    items = I.build_items(joined, R.PROMPT, F.col("text"), request_id=F.col("k").cast("string"))
    by_id = {int(r.request_id): r for r in scan.scan(items, pack, kinds=(R.PROMPT,)).collect()}
    want = []
    for k, conv, turn, role, _, size in told:
        v = by_id[k]
        large = size > LIMIT
        want.append((conv, turn, role, size, False if large else v.safe, "size_limit_exceeded" if large else v.threat_type,
                     "high" if large else v.confidence, f"Content too large ({int(size / 1024 + 0.5)}KB > {LIMIT / 1024:g}KB limit)" if large else v.reason))
    assert got == sorted(want, key=repr)


def test_histories_grow_with_the_input(spark):
    """A long conversation: references and segments hold each text once, and running verdicts shuffle no text."""
    df = spark.range(4000).select(F.lit(1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.lit("x" * 20).alias("text"))
    held = history.history_references(df, turns_per_block=64).agg(F.sum(F.length("text"))).first()[0]
    assert held == 80_000
    assert history.history_segments(df, turns_per_block=64).agg(F.sum(F.length("text"))).first()[0] == 80_000 + 3999
    plan = history.scan_turns(df)._jdf.queryExecution().executedPlan().toString()
    below = [line for line in plan.splitlines() if "Window" in line or "Exchange" in line]
    assert below and not any("text" in line for line in below)


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    refs = history.history_references(df)
    assert history.resolve_history(refs, history.history_segments(df)).count() == 0 and history.scan_turns(df).count() == 0
