"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contentgate.llm.common import save

WORD = r"[^\x20\x09-\x0D]+"
BINS = 4096


def uniform(key: Column) -> Column:
    """A number in (0, 1) that depends on the key's text alone."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("bigint").cast("double") + 0.5) / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """`sizes` (source, source_size) with a target per source; one row per source, the one table kept in one task.

    Sources in code point order, null last, take the weights in turn and share `share` of all sizes; a target stops at
    `most` times its source's size and the excess is shared again by weight. The level at which no target is above is
    found in one pass over the sources in order of the level at which they are full.
    """
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sizes.withColumn("_w", F.element_at(
        cycle, (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights) + 1))
    full = ranked.withColumn("_cap", F.col("source_size") * F.lit(float(most)))
    order = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    total = F.sum("source_size").over(Window.partitionBy()) * F.lit(float(share))
    before = F.coalesce(F.sum("_cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("_w").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    levels = full.withColumn("_level", (total - before) / rest)
    level = F.max(F.when(F.col("_level") <= F.col("_cap") / F.col("_w"), F.col("_level"))).over(Window.partitionBy())
    return levels.withColumn("_level", level).select(
        "source", "source_size", F.least("_cap", F.coalesce(F.col("_level") * F.col("_w"), F.col("_cap"))).alias("target"))


def mixture(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, id_col: str = "doc_id",
            text_col: str = "text", source_col: str = "source") -> DataFrame:
    """`docs` with _mix_size, _mix_source_size, _mix_target and _mix_copies: how often the mix takes each row.

    A document's inclusion is its source's target over its source's size. Its whole part is that many certain copies of
    every document; the rest p is drawn by Pareto order: rows of a source ranked by u / (1 - u) over p / (1 - p), with u
    from the id, taken in order as long as at least half of a document's words fit. The cut is searched by sums over
    `BINS` ranges of the rank and then within one range, so no task ranks a whole source, and reruns agree.

    A null text has size 0, a null source is a source (last in order), rows that repeat an id and a size are taken
    together, null ids rank as the empty text. An empty table gives an empty mix.
    """
    sized = docs.withColumn("_mix_size", F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("bigint"))
    keyed = save(sized.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), "_mix_size", uniform(F.col(id_col)).alias("u")))
    sizes = keyed.groupBy("source").agg(F.sum("_mix_size").alias("source_size"))
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    targets = save(
        source_targets(sizes, weights, share, most)
        .withColumn("whole", F.floor(expected).cast("bigint"))
        .withColumn("odds", (expected - F.col("whole")) / (1 - (expected - F.col("whole"))))
        .withColumn("left", F.col("target") - F.col("whole") * F.col("source_size")))

    def rank(u, odds):
        return F.when(odds > 0, u / (1 - u) / odds)

    drawn = keyed.join(targets.filter("odds > 0").select(F.col("source").alias("_s"), "odds", "left"),
                       F.col("source").eqNullSafe(F.col("_s"))).drop("_s").withColumn("_q", rank(F.col("u"), F.col("odds")))
    drawn = drawn.withColumn("_bin", F.floor(F.col("_q") / (1 + F.col("_q")) * BINS))
    bins = drawn.groupBy("source", "_bin").agg(F.sum("_mix_size").alias("_words"), F.first("left").alias("left"))
    upto = Window.partitionBy("source").orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bins = bins.withColumn("_before", F.sum("_words").over(upto) - F.col("_words"))
    edge = save(bins.filter("_before <= left").groupBy("source").agg(
        F.max("_bin").alias("_bin"), F.max_by("_before", "_bin").alias("_before")))
    inside = drawn.join(edge.withColumnRenamed("source", "_s").withColumnRenamed("_bin", "_b"),
                        F.col("source").eqNullSafe(F.col("_s")) & (F.col("_bin") == F.col("_b")))
    key = F.struct("_q", F.coalesce(F.col("id").cast("string"), F.lit("")).alias("_k"), "_mix_size")
    within = Window.partitionBy("source").orderBy(key).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fits = F.col("_before") + F.sum("_mix_size").over(within) - F.col("_mix_size") / 2 <= F.col("left")
    cuts = (
        inside.withColumn("_fits", fits).groupBy(F.col("source").alias("_s"))
        .agg(F.max(F.when(F.col("_fits"), key)).alias("_cut"), F.max("_b").alias("_cut_bin")))
    plan = save(targets.join(cuts, F.col("source").eqNullSafe(F.col("_s")), "left").select(
        F.col("source").alias("_mix_source"), F.col("source_size").alias("_mix_source_size"), F.col("target").alias("_mix_target"),
        F.col("whole").alias("_mix_whole"), F.col("odds").alias("_mix_odds"), F.col("_cut").alias("_mix_cut"),
        F.col("_cut_bin").alias("_mix_bin")))
    q = rank(uniform(F.col(id_col)), F.col("_mix_odds"))
    own = F.struct(q.alias("_q"), F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_k"), F.col("_mix_size"))
    taken = F.coalesce((F.floor(q / (1 + q) * BINS) < F.col("_mix_bin")) | (own <= F.col("_mix_cut")), F.lit(False))
    return sized.join(plan, F.col(source_col).eqNullSafe(F.col("_mix_source")), "left").select(
        *docs.columns, "_mix_size", "_mix_source_size", "_mix_target",
        (F.col("_mix_whole") + taken.cast("bigint")).alias("_mix_copies"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of `docs` as often as `mixture` takes it."""
    copies = F.sequence(F.lit(1).cast("bigint"), F.when(F.col("_mix_copies") > 0, F.col("_mix_copies")))
    return mixture(docs, **options).withColumn("_mix_copy", F.explode(copies)).select(docs.columns)
