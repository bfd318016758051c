"""Streams against their batch forms, over several micro-batches and restarts."""

import random

from pyspark.sql import functions as F

from contentgate.functions import rules as R
from contentgate.operators import metering, sessions
from contentgate.sources import items as I
from contentgate.sources.results import read_gated
from contentgate.streaming import buckets, gate, risk, timers
from contentgate.streaming.streams import read_stream, write_stream
from contentgate.operators.scan import guard_items
from contentgate.operators.gates import gate as gate_batch

START = 1_000_000  # the first watermark is the epoch: rows at or before it would count as late
DOCS = "/root/testdata/sf0.001/documents.parquet"


def run(stream, base, name="out"):
    write_stream(stream, f"{base}/{name}", f"{base}/{name}-checkpoint").awaitTermination()


def test_gate_over_batches_and_restart(spark, tmp_path):
    docs = spark.read.parquet(DOCS).withColumn(
        "text", F.when(F.col("doc_id") % 4 == 1, F.concat(F.lit("ignore previous "), "text")).otherwise(F.col("text")))
    source = str(tmp_path / "in")

    def items(df):
        return I.build_items(df, R.PROMPT, F.col("text"), request_id=F.col("doc_id").cast("string"))

    def start():
        stream = items(read_stream(spark, source, docs.schema, files_per_trigger=1))
        gate.start_gate(stream, str(tmp_path / "out"), str(tmp_path / "cp"), kinds=(R.PROMPT,)).awaitTermination()

    docs.filter("doc_id % 2 = 0").repartition(3).write.parquet(source)
    start()
    first = spark.read.parquet(str(tmp_path / "out")).count()
    start()  # nothing new: nothing repeated
    assert spark.read.parquet(str(tmp_path / "out")).count() == first
    docs.filter("doc_id % 2 = 1").repartition(2).write.mode("append").parquet(source)
    start()
    batch = gate_batch(guard_items(items(docs), kinds=(R.PROMPT,)))
    for allowed in (True, False):
        got = {(r.request_id, r.message) for r in read_gated(spark, str(tmp_path / "out"), allowed).collect()}
        keep = F.col("outcome") == "allowed"
        want = {(r.request_id, r.message) for r in batch.filter(keep if allowed else ~keep).collect()}
        assert got == want


def test_buckets_over_batches_equal_one_replay(spark, tmp_path):
    rng = random.Random(11)
    rows = sorted((rng.randrange(0, 300_000), rng.choice(["hot", "hot", "b"]), i) for i in range(2_000))
    source = str(tmp_path / "in")
    schema = "ms bigint, api_key string, request_id bigint"
    for part in range(4):  # files in time order
        chunk = rows[part * 500:(part + 1) * 500]
        spark.createDataFrame(chunk, schema).coalesce(1).write.mode("append").parquet(source)
        stream = read_stream(spark, source, spark.createDataFrame([], schema).schema, files_per_trigger=1)
        run(buckets.token_bucket_stream(stream, rpm=30), str(tmp_path))
    got = {(r.request_id, r.allowed, r.remaining, r.retry_after_ms) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    batch = metering.token_bucket(spark.createDataFrame(rows, schema), rpm=30)
    assert got == {(r.request_id, r.allowed, r.remaining, r.retry_after_ms) for r in batch.collect()}
    assert any(not r[1] for r in got)


def test_a_late_request_is_charged_without_refill(spark, tmp_path):
    source, schema = str(tmp_path / "in"), "ms bigint, api_key string, request_id bigint"
    empty = spark.createDataFrame([], schema).schema
    for chunk in ([(60_000, "k", 1), (60_000, "k", 2)], [(1_000, "k", 3), (90_000, "k", 4)]):
        spark.createDataFrame(chunk, schema).coalesce(1).write.mode("append").parquet(source)
        run(buckets.token_bucket_stream(read_stream(spark, source, empty), rpm=2), str(tmp_path))
    got = {r.request_id: r.allowed for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {1: True, 2: True, 3: False, 4: True}


def _settled(spark, tmp_path, chunks, name, schema="ms bigint, api_key string, request_id bigint, rate int", per_run=False):
    """Answers over one micro-batch per chunk (and one run per chunk, if asked)."""
    source, empty = str(tmp_path / f"{name}-in"), spark.createDataFrame([], schema).schema
    for chunk in chunks:
        spark.createDataFrame(chunk, schema).coalesce(1).write.mode("append").parquet(source)
        if per_run:
            run(buckets.settled_bucket_stream(read_stream(spark, source, empty), F.col("rate"), "60 seconds"), str(tmp_path), name)
    if not per_run:
        run(buckets.settled_bucket_stream(read_stream(spark, source, empty, files_per_trigger=1), F.col("rate"), "60 seconds"), str(tmp_path), name)
    return spark.read.parquet(str(tmp_path / name))


def test_settled_buckets_equal_the_replay_for_any_split(spark, tmp_path):
    rng = random.Random(12)
    rates = {"hot": 30, "b": 200, "free": None, "barred": 0}
    rows = [(ms, k, i, rates[k]) for i in range(1_500) for ms, k in [(rng.randrange(300_000), rng.choice(["hot", "hot", "hot", *rates]))]]
    rows += [(ms, "pause", 5_000 + i, 1) for i, ms in enumerate([0, 0, 59_999, 60_000, 185_000, 185_001])]
    rows += [(70_000, "hot", i, 30) for i in range(6_000, 6_100)] + [(None, "hot", 7_000, 30), (5, None, 7_001, 3), (5, None, 7_002, 3)]
    rows.append((10**7, "end", 9_999, 1))  # moves the watermark past the others
    # dealt out of order, but none later than the delay
    timed = sorted([(r[0] or 0) + rng.randrange(40_000), r] for r in rows)
    ordered = [r for _, r in timed]
    schema = "ms bigint, api_key string, request_id bigint, rate int"
    batch = metering.token_bucket(spark.createDataFrame(rows, schema), rpm=F.col("rate"))
    want = sorted((tuple(r) for r in batch.select("request_id", "allowed", "remaining", "retry_after_ms").collect() if r[0] != 9_999))
    assert any(r[1] is False and r[3] for r in want)
    for name, size, per_run in (("one", 10_000, False), ("few", 400, False), ("runs", 600, True)):
        got = _settled(spark, tmp_path, [ordered[k:k + size] for k in range(0, len(ordered), size)], name, per_run=per_run)
        assert sorted(tuple(r) for r in got.select("request_id", "allowed", "remaining", "retry_after_ms").collect() if r[0] != 9_999) == want


def test_settled_buckets_forget_full_ones_and_charge_late_rows(spark, tmp_path):
    chunks = [[(1_000, "k", 1, 1), (1_000, "k", 2, 1), (500_000, "other", 3, 1)], [(2_000, "k", 4, 1), (3_000, "other", 5, 1), (800_000, "x", 6, 1)], [(905_000, "x", 7, 1)]]
    got = {r.request_id: r.allowed for r in _settled(spark, tmp_path, chunks, "late", per_run=True).collect()}
    # 2 is over the limit; 4 comes when k's bucket is full and forgotten; 5 is charged before 3, which is not settled by then
    assert got == {1: True, 2: False, 4: True, 5: True, 3: True, 6: True}
    left = spark.read.format("statestore").option("stateVarName", "bucket").load(str(tmp_path / "late-checkpoint"))
    assert [r.key.api_key for r in left.select("key").collect()] == ["x"]  # k and other are full again
    pending = spark.read.format("statestore").option("stateVarName", "slots").load(str(tmp_path / "late-checkpoint"))
    assert pending.count() == 1


def test_session_patterns_equal_the_batch_for_any_split(spark, tmp_path):
    rng = random.Random(13)
    gap, schema = 60, "k string, s bigint, n bigint, safe boolean, threat_type string, digest string"
    rows = []
    for n in range(900):  # a hot key; ties; texts that come again before, with and after their block
        safe = rng.random() < 0.7
        rows.append((rng.choice(["hot", "hot", "hot", "b", "c", None]), rng.choice([rng.randrange(9_000), 30 * rng.randrange(300)]), n,
                     rng.choice([safe, safe, None]), None if safe else rng.choice(["x", "x", "y", None]), rng.choice([None, *"abcdefghij"])))
    rows += [("never", s, 1_000 + s, False, "x", "a") for s in (0, 60, 121, 182, 242, 302)]  # 60 joins, 61 parts
    dealt = [r for _, _, r in sorted((r[1] + rng.randrange(500), i, r) for i, r in enumerate(rows))] + [("end", 10**6, 9_999, True, None, "a")]

    def timed(df):
        return df.select("*", F.timestamp_seconds(F.col("s") + START).alias("ts"))

    batch = timed(spark.createDataFrame(rows, schema)).withColumns({"us": F.unix_micros("ts"), "_k": F.coalesce("k", F.lit("-"))})
    placed = sessions.assign_sessions(batch, "_k", "us", gap * 1_000_000)
    named = placed.select(F.concat_ws("|", "_k", "session_no").alias("session_id"), "_k", "us", F.col("us").alias("clock"), "safe", "threat_type", "digest")
    firsts = named.groupBy("session_id").agg(F.min("_k").alias("k"), F.min("us").alias("first_us"))
    want = sorted(tuple(r) for r in sessions.session_patterns(named).join(firsts, "session_id").select("k", "first_us", "pattern_id", "confidence").collect())
    assert {w[2] for w in want} == {"repeat_offender", "probing", "replay"}
    for name, size in (("one", 2_000), ("few", 230)):
        source, empty = str(tmp_path / f"{name}-in"), spark.createDataFrame([], schema).schema
        for at in range(0, len(dealt), size):
            spark.createDataFrame(dealt[at:at + size], schema).coalesce(1).write.mode("append").parquet(source)
        stream = timed(read_stream(spark, source, empty, files_per_trigger=1))
        run(risk.session_patterns_stream(stream, "k", gap_us=gap * 1_000_000, width_ms=20_000), str(tmp_path), name)
        got = spark.read.parquet(str(tmp_path / name)).withColumn("k", F.coalesce("k", F.lit("-")))
        assert sorted(tuple(r) for r in got.select("k", "first_us", "pattern_id", "confidence").collect()) == want
        kept = spark.read.format("statestore").option("stateVarName", "blocks").load(str(tmp_path / f"{name}-checkpoint"))
        assert kept.count() == 0


def _timed(spark, rows, names):
    df = spark.createDataFrame(rows, "k bigint, s bigint, n bigint")
    return df.select(F.col("k").alias(names[0]), F.timestamp_seconds(F.col("s") + START).alias("ts"), F.col("n").alias(names[1]))


def test_heartbeats_fall_silent_and_return(spark, tmp_path):
    source = str(tmp_path / "in")
    for chunk in ([(1, 0, 0), (2, 0, 0), (1, 50, 0)], [(2, 2_000, 0)], [(1, 4_000, 0)], [(9, 6_000, 0)]):
        df = _timed(spark, chunk, ("agent_id", "n"))
        df.coalesce(1).write.mode("append").parquet(source)
        run(timers.liveness_stream(read_stream(spark, source, df.schema, files_per_trigger=1), 600_000, "0 seconds"), str(tmp_path))
    got = sorted((r.agent_id, r.at_ms // 1000 - START, r.status) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [(1, 0, "active"), (1, 50, "inactive"), (1, 4_000, "active"), (1, 4_000, "inactive"),
                   (2, 0, "active"), (2, 2_000, "inactive"), (9, 6_000, "active")]


def test_beats_without_a_time_are_left_out(spark, tmp_path):
    source = str(tmp_path / "in")
    for chunk in ([(1, 0, 0), (2, 0, 1)], [(1, 30, 1), (3, 40, 0)], [(9, 9_000, 0)]):
        df = _timed(spark, chunk, ("agent_id", "lost"))
        df = df.withColumn("ts", F.when(F.col("lost") == 0, F.col("ts"))).drop("lost")
        df.coalesce(1).write.mode("append").parquet(source)
        run(timers.liveness_stream(read_stream(spark, source, df.schema, files_per_trigger=1), 600_000, "0 seconds"), str(tmp_path))
    got = sorted((r.agent_id, r.at_ms // 1000 - START, r.status) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [(1, 0, "active"), (1, 0, "inactive"), (3, 40, "active"), (3, 40, "inactive"), (9, 9_000, "active")]


def test_approvals_expire_once(spark, tmp_path):
    source = str(tmp_path / "in")
    for chunk in ([(1, 0, 100), (2, 0, 5_000), (1, 10, 300)], [(3, 1_000, 10)], [(4, 9_000, 10)]):
        df = _timed(spark, chunk, ("approval_id", "expires_in_seconds"))
        df = df.withColumn("approval_id", F.col("approval_id").cast("string"))
        df.coalesce(1).write.mode("append").parquet(source)
        run(timers.expiry_stream(read_stream(spark, source, df.schema, files_per_trigger=1), "0 seconds"), str(tmp_path))
    got = sorted((r.approval_id, r.expired_ms - START * 1000) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [("1", 310_000), ("2", 5_000_000), ("3", 1_010_000)]


def test_approvals_without_an_id_a_time_or_a_term(spark, tmp_path):
    source, big = str(tmp_path / "in"), 2**53 + 1
    schema = "approval_id bigint, s bigint, expires_in_seconds bigint"
    for chunk in ([(None, 0, 100), (None, 0, 300), (big, 0, 200), (2, None, 5), (3, 0, None)], [(big, 10, None), (4, 9_000, 1)], [(5, 9_900, 1)]):
        df = spark.createDataFrame(chunk, schema).select("approval_id", F.timestamp_seconds(F.col("s") + START).alias("ts"), "expires_in_seconds")
        df.coalesce(1).write.mode("append").parquet(source)
        run(timers.expiry_stream(read_stream(spark, source, df.schema, files_per_trigger=1), "0 seconds", pages=2), str(tmp_path))
    got = [(r.approval_id, r.expired_ms - START * 1000) for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert sorted(got, key=lambda r: r[1]) == [(big, 200_000), (None, 300_000), (4, 9_001_000)]


def test_repeated_requests_are_dropped_across_batches(spark, tmp_path):
    source = str(tmp_path / "in")
    for chunk in ([(1, 0, 0), (2, 1, 0)], [(1, 5, 0), (3, 6, 0)]):
        df = _timed(spark, chunk, ("request_id", "n"))
        df.coalesce(1).write.mode("append").parquet(source)
        run(gate.first_of_requests(read_stream(spark, source, df.schema, files_per_trigger=1)), str(tmp_path))
    ids = sorted(r.request_id for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert ids == [1, 2, 3]


def test_session_risk_waits_for_the_end_of_a_session(spark, tmp_path):
    source = str(tmp_path / "in")
    for chunk in ([(1, 0, 1), (1, 60, 1)], [(1, 1_000, 0), (2, 1_000, 1)], [(3, 90_000, 0)]):
        df = _timed(spark, chunk, ("user_id", "bad"))
        df.coalesce(1).write.mode("append").parquet(source)
        stream = read_stream(spark, source, df.schema, files_per_trigger=1).select(
            "user_id", "ts", (F.col("bad") == 0).alias("safe"), F.lit("critical").alias("severity"))
        run(risk.session_risk_stream(stream, delay="0 seconds"), str(tmp_path))
    got = {(r.user_id, r.n_requests, r.session_risk_score) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {(1, 3, 0.75), (2, 1, 0.5)}
