"""Usage against quotas, and token-bucket rate limits replayed over a log."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from contentgate.functions.taxonomy import literal_map
from contentgate.operators.keyed import floor_div
from contentgate.session import shared_dir

# Limits per tier, and the default client limit.
TIER_QUOTAS = {"community": 1_000, "pro": 25_000, "enterprise": 1_000_000}
TIER_RPM = {"community": 10, "pro": 100, "enterprise": 1_000}
DEFAULT_RPM = 100

TOKEN = 60_000  # units per token: a bucket gains rpm units per millisecond
REFILL_MS = 60_000  # an idle bucket is full again after this long, whatever its rate


def quota_of(tier: Column) -> Column:
    """Scans a month per tier; NULL (no quota) for callers without one."""
    return literal_map(TIER_QUOTAS)[tier].cast("bigint")


def month_of(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def monthly_usage(requests: DataFrame, tiers: DataFrame, clock: str = "ts") -> DataFrame:
    """Production scans per key and month next to the quota of the key's tier.

    Counted before the tiers are joined, so the join sees one row per key and month.
    """
    used = (
        requests.filter(F.coalesce(F.col("mode"), F.lit("production")) != "sandbox")
        .groupBy("api_key", month_of(F.col(clock)).alias("month"))
        .agg(F.count(F.lit(1)).alias("n_scans"))
    )
    # a key with several tier rows keeps one, so that its usage is not repeated
    one = tiers.groupBy("api_key").agg(F.max("tier").alias("tier"))
    joined = used.join(one, "api_key", "left").withColumn("quota", quota_of(F.col("tier")))
    return joined.select(
        "api_key", "month", "n_scans", "tier", "quota",
        F.coalesce(F.col("n_scans") > F.col("quota"), F.lit(False)).alias("over_quota"),
    )


def _carried(rows: DataFrame, group: list[str], part: str) -> DataFrame:
    """Per (group, part): how many rows of the group come before it (from ``_base``), and whether a quota may end inside it."""
    counts = rows.groupBy(*group, part).agg(
        F.min("_base").alias("_base"), F.count(F.lit(1)).alias("_n"), F.min("quota").alias("_least"), F.max("quota").alias("_most"))
    earlier = W.partitionBy(*group).orderBy(part).rowsBetween(W.unboundedPreceding, -1)
    before = F.col("_base") + F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    inside = (F.col("_most") > F.col("_before")) & (F.col("_least") < F.col("_before") + F.col("_n"))
    return counts.withColumn("_before", before).select(*group, part, "_before", F.coalesce(inside, F.lit(False)).alias("_inside"))


def quota_rows(requests: DataFrame, quota: Column, clock: str = "ts") -> DataFrame:
    """Mark the production requests of a key past its monthly quota, in (time, id) order.

    The request that exhausts a quota is looked for in ever smaller parts. Counts per (key, month, minute) and their running
    sum settle every minute that lies wholly within or past the quota. The minutes in which a quota ends, one per key and month
    if the quota is the same for all rows of a key, are cut at sampled splitters of (key, month, time, id) into pieces
    of like size, whatever a minute holds, and saved in the shared folder; counts per piece settle all pieces but those
    in which a quota ends. Only these are sorted. ``quota`` is evaluated on the request row. A request without a time has no
    month and is past no quota.
    """
    live = requests.filter(F.coalesce(F.col("mode"), F.lit("production")) != "sandbox").select(
        "request_id", "api_key", F.coalesce("api_key", F.lit("")).alias("_key"), F.col(clock).alias("_ts"), quota.cast("bigint").alias("quota"),
        month_of(F.col(clock)).alias("month"),
        F.date_trunc("minute", F.col(clock)).alias("_minute"),
    )
    past = F.coalesce(F.col("_before") >= F.col("quota"), F.lit(False)).alias("over_quota")
    minutes = ["_key", "month", "_minute"]
    placed = live.join(_carried(live.withColumn("_base", F.lit(0).cast("bigint")), minutes[:2], "_minute"), minutes, "left")
    settled = placed.filter(~F.coalesce("_inside", F.lit(False))).select("request_id", "api_key", "month", past)

    order = ["_ts", "request_id", "_tie"]  # rows alike in all of these are apart by their number
    split = (
        placed.filter("_inside").select(*live.columns, F.col("_before").alias("_base"), F.monotonically_increasing_id().alias("_tie"))
        .repartitionByRange(*minutes, *order).withColumn("_piece", F.spark_partition_id()))
    path = shared_dir(requests.sparkSession)  # counted and read again with the same pieces
    split.write.parquet(path)
    pieces = requests.sparkSession.read.schema(split.schema).parquet(path)
    cut = [*minutes, "_piece"]
    placed = pieces.join(_carried(pieces, minutes, "_piece"), cut)
    whole = placed.filter(~F.col("_inside")).select("request_id", "api_key", "month", past)
    rank = F.row_number().over(W.partitionBy(*cut).orderBy(*order))
    ends = placed.filter("_inside").withColumn("_rank", rank).select(
        "request_id", "api_key", "month", F.coalesce(F.col("_before") + F.col("_rank") > F.col("quota"), F.lit(False)).alias("over_quota"))
    return settled.unionByName(whole).unionByName(ends)


def fold_runs(groups: DataFrame) -> DataFrame:
    """Minutes (_key, slot) of each key, numbered by the ``run`` that can be folded on its own, from a full bucket.

    ``groups`` holds one row per key and millisecond: _key, _ms, _n requests and their rate _rpm. A run begins after a
    minute of silence, or with a minute whose first request surely meets a full bucket. For that, think of a bucket that
    charges every request, the denied ones too, and so never holds more than the real one. Without its cap it would run
    along a free sum of what it gains and pays; with the cap it lies below that by the largest overshoot so far. It is
    full at a request exactly where (cap - free sum) is no higher than at any earlier request, and there the real one
    is full too.

    Sums and lows are taken within each minute, then over the minutes of a key: no task orders more than one minute of
    requests or one row per minute of a key. A key over its limit in every minute has no full bucket to begin from.
    """
    line = W.partitionBy("_key", "slot").orderBy("_ms")
    earlier = line.rowsBetween(W.unboundedPreceding, -1)
    timed = groups.withColumn("slot", floor_div(F.col("_ms"), REFILL_MS)).withColumn(
        "_gained", F.coalesce((F.col("_ms") - F.lag("_ms").over(line)) * F.col("_rpm"), F.lit(0)))
    free = F.sum("_gained").over(line.rowsBetween(W.unboundedPreceding, 0)) - TOKEN * F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    slots = timed.withColumn("_room", F.col("_rpm") * TOKEN - free).groupBy("_key", "slot").agg(
        F.min("_ms").alias("_first"), F.max("_ms").alias("_last"), F.min_by("_rpm", "_ms").alias("_rate"),
        (F.sum("_gained") - TOKEN * F.sum("_n")).alias("_moved"), F.min("_room").alias("_room"))
    minutes = W.partitionBy("_key").orderBy("slot")
    slots = slots.withColumn("_silence", F.col("_first") - F.lag("_last").over(minutes)).withColumn(
        "_quiet", F.coalesce(F.col("_silence") >= REFILL_MS, F.lit(True)).cast("int"))
    slots = slots.withColumn("_stretch", F.sum("_quiet").over(minutes.rowsBetween(W.unboundedPreceding, 0)))
    stretch = W.partitionBy("_key", "_stretch").orderBy("slot")
    before = stretch.rowsBetween(W.unboundedPreceding, -1)
    came = F.when(F.col("_quiet") == 1, F.lit(0)).otherwise(F.col("_silence") * F.col("_rate"))
    slots = slots.withColumn("_free", F.sum(came).over(stretch.rowsBetween(W.unboundedPreceding, 0)) + F.coalesce(F.sum("_moved").over(before), F.lit(0)))
    lowest = F.min(F.col("_room") - F.col("_free")).over(before)
    full = F.coalesce(F.col("_rate") * TOKEN - F.col("_free") <= lowest, F.lit(True))
    slots = slots.withColumn("_full", full.cast("int"))
    return slots.select("_key", "slot", F.sum("_full").over(minutes.rowsBetween(W.unboundedPreceding, 0)).alias("run"))


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Units in the bucket ahead of each group of simultaneous requests.

    Rows arrive sorted by (key, run, ms). State is two integers carried across
    batches; a run starts with a full bucket.
    """
    owner, units, last = None, 0, 0
    for batch in batches:
        before = []
        rpm_ms_n = (batch.column(c).to_numpy().tolist() for c in ("_rpm", "_ms", "_n"))
        for who, rpm, ms, n in zip(batch.column("_who").to_pylist(), *rpm_ms_n):
            full = rpm * TOKEN
            if who != owner:
                owner, units = who, full
            else:
                units = min(full, units + (ms - last) * rpm)
            last = ms
            before.append(units)
            units -= min(n, units // TOKEN) * TOKEN
        kept = [batch.column(c) for c in ("_key", "_ms", "_n")]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(before, pa.int64())], names=["_key", "_ms", "_n", "_units"])


def token_bucket(
    df: DataFrame, rpm: int | Column = DEFAULT_RPM, key: str = "api_key", clock: str = "ms", order: str = "request_id",
) -> DataFrame:
    """Replay a token bucket per key: adds allowed, remaining and retry_after_ms.

    The bucket holds ``rpm`` tokens, starts full and refills continuously; a request takes
    one token or is denied and takes none. Requests are ordered by (``clock`` in
    milliseconds, ``order`` by its own type, NULL first). Integer units make the result exact.

    The fold is sequential by nature, so it runs on as little as possible:

    * requests of one key and millisecond differ only in their place in line, so they are
      counted on the map side and the fold sees one row per (key, ms), not per request;
    * where a bucket is surely full (after a minute of silence, or see ``fold_runs``) what
      happened before does not matter, so a key is folded in as many pieces as there are such
      minutes; they are found from the counts;
    * per-request answers follow from the units ahead of the group and the place in it, by
      a join on (key, ms) that spreads a busy key over all tasks.

    A NULL rate is no limit: the request is allowed, with remaining NULL. At a rate of 0 or
    less every request is denied, with no time to retry. A request without a time, or (where
    there is a ``mode`` column) in the sandbox, takes no token and has no answer.
    """
    rate = F.lit(rpm) if isinstance(rpm, int) else rpm
    # requests without a key are one caller, like a blank key
    keyed = df.withColumn("_key", F.coalesce(F.col(key).cast("string"), F.lit(""))).withColumn("_rate", rate.cast("bigint"))
    live = F.col(clock).isNotNull()
    if "mode" in df.columns:
        live = live & (F.coalesce(F.col("mode"), F.lit("production")) != "sandbox")
    # only what is counted has a millisecond here
    keyed = keyed.withColumn("_live", live).withColumn("_ms", F.when(live & (F.col("_rate") > 0), F.col(clock).cast("bigint")))
    groups = keyed.filter(F.col("_ms").isNotNull()).groupBy("_key", "_ms").agg(
        F.count(F.lit(1)).alias("_n"), F.max("_rate").alias("_rpm"))
    runs = fold_runs(groups)
    slotted = groups.withColumn("slot", floor_div(F.col("_ms"), REFILL_MS))
    ordered = (
        slotted.join(runs, ["_key", "slot"], "left")
        .select("_key", F.concat_ws("|", F.coalesce(F.col("run"), F.lit(0)).cast("string"), "_key").alias("_who"), "_rpm", "_ms", "_n")
        .repartition("_who")
        .sortWithinPartitions("_who", "_ms")
    )
    states = ordered.mapInArrow(_fold, "_key string, _ms bigint, _n bigint, _units bigint")
    place = F.row_number().over(W.partitionBy("_key", "_ms").orderBy(order))
    joined = keyed.filter(F.col("_ms").isNotNull()).join(states, ["_key", "_ms"]).withColumn("_place", place)
    granted = F.least(F.col("_n"), F.expr(f"_units div {TOKEN}"))
    allowed = F.col("_place") <= granted
    left = F.expr(f"(_units - _place * {TOKEN}) div {TOKEN}")
    missing = F.lit(TOKEN) - (F.col("_units") - granted * TOKEN)
    counted = joined.select(
        *df.columns,
        allowed.alias("allowed"),
        F.when(allowed, left).when(~allowed, 0).cast("bigint").alias("remaining"),
        F.when(~allowed, F.ceil(missing / F.col("_rate"))).cast("bigint").alias("retry_after_ms"),
    )
    others = keyed.filter(F.col("_ms").isNull()).select(
        *df.columns,
        F.when(F.col("_live"), F.col("_rate").isNull()).alias("allowed"),
        F.when(F.col("_live") & F.col("_rate").isNotNull(), F.lit(0)).cast("bigint").alias("remaining"),
        F.lit(None).cast("bigint").alias("retry_after_ms"),
    )
    return counted.unionByName(others)
