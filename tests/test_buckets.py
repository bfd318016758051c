"""The token bucket against a direct simulation, on random and on lopsided logs."""

import random
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from contentgate.operators import metering


def simulate(rows, rpm_of):
    """Rows of (key, ms, id) in any order -> {(key, ms, id): (allowed, remaining, retry)}."""
    answers, lines = {}, defaultdict(list)
    for key, ms, rid in rows:
        lines[key or ""].append((ms, rid, key))
    for line in lines.values():
        rpm = rpm_of(line[0][2])
        units, last = rpm * 60_000, None
        for ms, rid, key in sorted(line, key=lambda x: (x[0], x[1])):
            units = min(rpm * 60_000, units + (0 if last is None else (ms - last) * rpm))
            last = ms
            if units >= 60_000:
                units -= 60_000
                answers[key, ms, rid] = (True, units // 60_000, None)
            else:
                answers[key, ms, rid] = (False, 0, -(-(60_000 - units) // rpm))
    return answers


def replay(spark, rows, rpm=10):
    df = spark.createDataFrame(rows, "api_key string, ms bigint, request_id bigint")
    rate = rpm if isinstance(rpm, int) else F.when(F.col("api_key") == "slow", 1).otherwise(100)
    return {(r.api_key, r.ms, r.request_id): (r.allowed, r.remaining, r.retry_after_ms)
            for r in metering.token_bucket(df, rpm=rate).collect()}


def test_published_edges(spark):
    rows = [("k", 0, i) for i in range(101)] + [("k", 599, 200), ("k", 600, 201)]
    got = replay(spark, rows, 100)
    assert [got["k", 0, i][1] for i in range(100)] == list(range(99, -1, -1))
    assert got["k", 0, 100] == (False, 0, 600)
    assert got["k", 599, 200] == (False, 0, 1)
    assert got["k", 600, 201][0] is True


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(-90_000, 200_000)), min_size=1, max_size=120),
       st.sampled_from([1, 7, 60]))
def test_random_traces(spark, trace, rpm):
    rows = [(key, ms, i) for i, (key, ms) in enumerate(trace)]
    assert replay(spark, rows, rpm) == simulate(rows, lambda _: rpm)


def test_runs_of_a_busy_key_are_cut_at_a_full_minute_of_silence(spark):
    times = [0, 1, 60_000, 60_001, 120_001, 120_002, 240_000, 240_000, 299_999, 360_000]
    rows = [("hot", ms, i) for i, ms in enumerate(times)]
    for rpm in (1, 2):
        assert replay(spark, rows, rpm) == simulate(rows, lambda _: rpm)


def runs_of(spark, rows, rpm):
    df = spark.createDataFrame([(k, ms) for k, ms, _ in rows], "_key string, _ms bigint").groupBy("_key", "_ms").agg(F.count(F.lit(1)).alias("_n"))
    return metering.fold_runs(df.withColumn("_rpm", F.lit(rpm).cast("bigint"))).select("_key", "run").distinct().count()


@pytest.mark.parametrize("rpm, pieces", [(60, 700), (75, 700), (55, 0)])
def test_a_key_that_is_never_silent_is_folded_in_many_pieces(spark, rpm, pieces):
    """A request every second for a day, with bursts; a rate below the demand leaves nothing to cut."""
    rng = random.Random(11)
    rows = [("hot", 1_000 * s, s) for s in range(86_400)]
    if rpm == 75:
        rows += [("hot", 1_000 * s + rng.randrange(1_000), 100_000 + i) for i, s in enumerate(rng.choices(range(86_400), k=600)) for _ in range(1)]
        rows += [("hot", 40_000_000, 200_000 + i) for i in range(300)]
    assert replay(spark, rows, rpm) == simulate(rows, lambda _: rpm)
    assert runs_of(spark, rows, rpm) >= pieces


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 40), st.integers(1, 30_000), st.integers(1, 12)), min_size=30, max_size=120), st.sampled_from([3, 10, 25]))
def test_busy_traces(spark, trace, rpm):
    """Bursts a few seconds apart, never a silent minute: full buckets come and go."""
    at, rows = {"a": 0, "b": 5}, []
    for key, _, gap, burst in trace:
        at[key] += gap
        rows += [(key, at[key], len(rows) + i) for i in range(burst)]
    assert replay(spark, rows, rpm) == simulate(rows, lambda _: rpm)


def test_cuts_where_rates_change_within_a_key(spark):
    rng = random.Random(2)
    rows = [("k", 700 * i, i, 5 if (700 * i) // 200_000 % 2 else 90) for i in range(2_000) if rng.random() < 0.8]
    df = spark.createDataFrame(rows, "api_key string, ms bigint, request_id bigint, rate bigint")
    got = {r.request_id: (r.allowed, r.remaining) for r in metering.token_bucket(df, rpm=F.col("rate")).collect()}
    units, last, want = 90 * 60_000, 0, {}
    units = rows[0][3] * 60_000
    last = rows[0][1]
    for _, ms, rid, rpm in rows:
        units = min(rpm * 60_000, units + (ms - last) * rpm)
        last = ms
        ok = units >= 60_000
        units -= 60_000 * ok
        want[rid] = (ok, units // 60_000 if ok else 0)
    assert got == want


def test_one_key_and_one_millisecond_hold_most_rows(spark):
    rng = random.Random(7)
    rows = [("hot", 5_000, i * 7_919) for i in range(3_000)] 
    rows += [("hot", rng.randrange(0, 400_000), 50_000_000 + i) for i in range(2_000)]
    rows += [(rng.choice(["x", "slow", None]), rng.randrange(0, 400_000), 90_000_000 + i) for i in range(1_000)]
    assert replay(spark, rows, "tiers") == simulate(rows, lambda key: 1 if key == "slow" else 100)


def test_text_ids_keep_their_order(spark):
    rows = [(f"{i:06d}", 0) for i in range(50)]
    df = spark.createDataFrame(rows, "request_id string, ms bigint").withColumn("api_key", F.lit("k"))
    got = {r.request_id for r in metering.token_bucket(df, rpm=20).filter("allowed").collect()}
    assert got == {f"{i:06d}" for i in range(20)}


def test_order_follows_the_type_of_the_id(spark):
    df = spark.sql("SELECT 'k' AS api_key, 0L AS ms, CAST(c AS DECIMAL(10,1)) AS request_id FROM VALUES (10), (9), (NULL) AS t(c)")
    got = {r.request_id: r.allowed for r in metering.token_bucket(df, rpm=2).collect()}
    assert got == {None: True, 9: True, 10: False}


def test_callers_without_a_rate_and_with_none_left(spark):
    df = spark.createDataFrame([("free", 0, 1), ("none", 0, 2), ("free", None, 3)], "api_key string, ms bigint, request_id bigint")
    rate = F.when(F.col("api_key") == "none", 0)
    got = {r.request_id: (r.allowed, r.remaining, r.retry_after_ms) for r in metering.token_bucket(df, rpm=rate).collect()}
    assert got == {1: (True, None, None), 2: (False, 0, None), 3: (None, None, None)}


def test_two_tier_rows_do_not_double_usage(spark):
    df = spark.createDataFrame([("k", "1"), ("k", "2")], "api_key string, request_id string").withColumn(
        "ts", F.timestamp_seconds(F.lit(1_700_000_000))).withColumn("mode", F.lit(None).cast("string"))
    tiers = spark.createDataFrame([("k", "pro"), ("k", "community")], "api_key string, tier string")
    assert [r.n_scans for r in metering.monthly_usage(df, tiers).collect()] == [2]


def test_requests_without_a_time_stay(spark):
    df = spark.createDataFrame([("k", None, 1), ("k", 5, 2)], "api_key string, ms bigint, request_id bigint")
    got = {r.request_id: r.allowed for r in metering.token_bucket(df).collect()}
    assert got == {1: None, 2: True}


@pytest.mark.parametrize("quota", [0, 1, 700, 5_000])
def test_quota_with_one_busy_key(spark, quota):
    rng = random.Random(3)
    base = 1_700_000_000
    rows = [("hot" if i % 3 else rng.choice(["a", None]), base + rng.randrange(0, 90), f"{i:05d}") for i in range(3_000)]
    df = spark.createDataFrame(rows, "api_key string, s bigint, request_id string").select(
        "api_key", F.timestamp_seconds("s").alias("ts"), "request_id", F.lit("production").alias("mode"))
    got = {r.request_id: r.over_quota for r in metering.quota_rows(df, F.lit(quota)).collect()}
    want, seen = {}, defaultdict(int)
    for key, s, rid in sorted(rows, key=lambda r: (r[1], r[2])):
        seen[key] += 1
        want[rid] = seen[key] > quota
    assert got == want


def test_sandbox_requests_are_not_metered(spark):
    df = spark.createDataFrame([("k", "sandbox", "1"), ("k", None, "2")], "api_key string, mode string, request_id string")
    df = df.withColumn("ts", F.timestamp_seconds(F.lit(1_700_000_000)))
    tiers = spark.createDataFrame([("k", "community")], "api_key string, tier string")
    row = metering.monthly_usage(df, tiers).first()
    assert (row.n_scans, row.quota, row.over_quota) == (1, 1000, False)
    assert metering.quota_rows(df, F.lit(0)).count() == 1


def test_quota_that_ends_in_a_hot_minute(spark):
    """One minute holds most rows, at distinct and at equal times; the quota's end is looked for in a piece of it."""
    rng = random.Random(8)
    rows = [("hot", "2024-01-05 10:00:%02d.%03d" % (rng.randrange(60), rng.randrange(40)), i) for i in range(4_000)]
    rows += [("hot", "2024-01-05 10:00:30.500", i) for i in range(5_000, 9_000)] + [("hot", "2024-01-05 10:00:30.500", 42)] * 500
    rows += [("hot", f"2024-01-{d:02d} 09:00:00", 10_000 + d) for d in range(1, 30)] + [("b", "2024-01-05 10:00:01", i) for i in range(20)]
    rows += [(None, "2024-01-05 10:00:01", i) for i in range(9)] + [("hot", "2024-02-01 00:00:00", 1), ("hot", None, 2)]
    df = spark.createDataFrame([(k, t, i, None) for k, t, i in rows], "api_key string, t string, request_id bigint, mode string").withColumn("ts", F.to_timestamp("t"))
    for quotas in ({"hot": 5_000, "b": 7}, {"hot": 3}, {"hot": 10**6, "b": 0}, {"hot": 8_517, "b": 20}):
        limit = F.when(F.col("api_key") == "hot", quotas["hot"]).when(F.col("api_key") == "b", quotas.get("b"))
        got = sorted(((r.api_key or "", r.request_id, r.over_quota) for r in metering.quota_rows(df, limit).collect()))
        want, used = [], {}
        for k, t, i in sorted(rows, key=lambda r: (r[1] or "", r[2])):
            month = (k, t and t[:7])
            used[month] = used.get(month, 0) + 1
            want.append((k or "", i, t is not None and quotas.get(k) is not None and used[month] > quotas[k]))
        assert got == sorted(want)
