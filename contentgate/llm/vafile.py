"""Exact top-k search with vector-approximation files."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contentgate.llm.common import save

CELLS = 256  # a byte per dimension
BLOCK = 4096
QUERIES = 1024


def integers(vector: str, scale: int) -> Column:
    return F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * scale).cast("bigint"))


def usable(vector: str) -> Column:
    """Not null, not empty, and no component null or non-finite."""
    bad = F.exists(F.col(vector), lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~bad, F.lit(False))


def approximations(vectors: DataFrame, id_col: str, vector: str, scale: int) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """The approximation file: row number, id, the cell of every dimension as one byte, and the exact integers; and the grid.

    The grid cuts each dimension's range into `CELLS` equal cells; only two numbers per dimension reach the driver.
    """
    whole = vectors.filter(usable(vector) & F.col(id_col).isNotNull()).select(
        F.monotonically_increasing_id().alias("no"), F.col(id_col).cast("bigint").alias("vec_id"), integers(vector, scale).alias("x"))
    whole = save(whole)
    grid = whole.select(F.posexplode("x")).groupBy("pos").agg(F.min("col").alias("lo"), F.max("col").alias("hi")).orderBy("pos").collect()
    d = len(grid)
    short = F.concat("x", F.array_repeat(F.lit(0).cast("bigint"), F.lit(d) - F.size("x")))
    lo = np.array([min(0, r["lo"]) if r["lo"] > 0 else r["lo"] for r in grid], dtype=float)
    hi = np.array([max(0, r["hi"]) if r["hi"] < 0 else r["hi"] for r in grid], dtype=float)
    step = (hi - lo + 1) / CELLS if d else hi

    def cells(batches):
        for batch in batches:
            x = np.array(batch.column(2).to_pylist(), dtype=np.int64).reshape(batch.num_rows, d)
            c = np.minimum((x - lo) // step, CELLS - 1).astype(np.uint8)
            pack = lambda m: pa.array([row.tobytes() for row in m], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pack(c), pack(x)], names=["no", "vec_id", "cells", "exact"])

    return whole.select("no", "vec_id", short.alias("x")).mapInArrow(cells, "no bigint, vec_id bigint, cells binary, exact binary"), lo, step


def unpack(column: pd.Series, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=kind).reshape(len(column), -1)


def limited(rows: DataFrame, by: list[str], order: list, n: int) -> DataFrame:
    """The first n rows of each group. Spark cuts groups to n rows before they move, so none is gathered whole."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return rows.withColumn("_place", place).filter(F.col("_place") <= n).drop("_place")


def in_blocks(points: DataFrame, queries: DataFrame, n_points: int, n_queries: int):
    """Queries and points dealt by their row numbers into (block, group) tasks of about BLOCK points and QUERIES queries."""
    blocks, groups = max(1, -(-n_points // BLOCK)), max(1, -(-n_queries // QUERIES))
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    p = points.withColumn("block", F.pmod(F.xxhash64("no"), F.lit(blocks)).cast("int")).withColumn("group", all_of(groups))
    q = queries.withColumn("group", F.pmod(F.xxhash64("q_no"), F.lit(groups)).cast("int")).withColumn("block", all_of(blocks))
    return p.groupBy("block", "group"), q.groupBy("block", "group")


def scored(pairs: DataFrame, points: DataFrame, queries: DataFrame) -> DataFrame:
    """(q_no, query_id, vec_id, score) of pairs (q_no, no): the exact vectors of these alone are read."""
    both = pairs.join(points.select("no", "vec_id", "exact"), "no").join(queries.select("q_no", "query_id", "q"), "q_no")

    def products(batches):
        for batch in batches:
            if batch.num_rows:
                x, q = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.int64).reshape(batch.num_rows, -1) for c in ("exact", "q"))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("q_no"), batch.column("query_id"), batch.column("vec_id"), pa.array(np.einsum("ij,ij->i", x, q))],
                    names=["q_no", "query_id", "vec_id", "score"])

    return both.select("q_no", "query_id", "vec_id", "exact", "q").mapInArrow(products, "q_no bigint, query_id bigint, vec_id bigint, score bigint")


def top_k(vectors: DataFrame, every: int = 20, k: int = 20, scale: int = 64, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The k best inner products of every query: query_id, rank, vec_id, score.

    Vectors become integers floor(scale * x); queries are the rows whose id is divisible by `every`, candidates all rows
    with another id. Equal scores go to the smaller id. Two scans read cells only: with q . x between q . mid - r and
    q . mid + r, the kth largest lower bound of a block, rows with the query's own id left out, is a score that its kth
    result has at least, and the largest over the blocks is the query's floor. The second scan passes on the pairs whose
    upper bound reaches the floor. Of those the exact vectors are read in the order of their bounds: first 4 k pairs a
    query, and then the others that reach the kth score among these. Results are exact.

    Vectors that are null, empty or hold null or non-finite components, and rows without an id, take no part; shorter
    vectors count as filled up with zeros. An empty table gives no rows. An id on several rows: none of them is a
    candidate of a query with that id, as candidates of others each counts; equal rows are one query, and an id with
    several vectors has a ranking for each. Of equal vectors only the 2 k smallest ids can be results, so copies beyond
    them, and beyond k of one id, are left out before the scans. Components are below 2^25 in size.
    """
    points, lo, step = approximations(vectors, id_col, vector, scale)
    points = save(points)
    queries = points.filter(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), F.col("exact").alias("q")).distinct()
    queries = save(queries.withColumn("q_no", F.monotonically_increasing_id()))
    points = save(limited(limited(points, ["exact", "vec_id"], ["no"], k), ["exact"], ["vec_id", "no"], 2 * k))
    n_points, n_queries = points.count(), queries.count()

    def bounds(p: pd.DataFrame, q: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """Estimate of every (query, point), minus infinity for a query's own rows, and how far off it may be for each query."""
        vectors = unpack(q["q"], np.int64).astype(float)
        near = vectors @ (lo + (unpack(p["cells"], np.uint8) + 0.5) * step).T
        ids, asked = p["vec_id"].to_numpy(), q["query_id"].to_numpy()
        for j in np.flatnonzero(np.isin(ids, asked)):
            near[asked == ids[j], j] = -np.inf
        return near, np.abs(vectors) @ (step / 2)

    def least(p: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if len(p) < k or q.empty:
            return pd.DataFrame({"q_no": q["q_no"].iloc[:0], "floor": pd.Series(dtype=float)})
        near, off = bounds(p, q)
        return pd.DataFrame({"q_no": q["q_no"], "floor": np.partition(near, len(p) - k, axis=1)[:, len(p) - k] - off})

    def reaching(p: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if p.empty or q.empty:
            return pd.DataFrame({"q_no": [], "no": [], "upper": []}).astype({"q_no": "int64", "no": "int64", "upper": float})
        near, off = bounds(p, q)
        upper = near + off[:, None] + 0.5  # half a unit, far above any rounding
        a, b = np.nonzero((upper >= q["floor"].fillna(-np.inf).to_numpy()[:, None]) & np.isfinite(upper))
        return pd.DataFrame({"q_no": q["q_no"].to_numpy()[a], "no": p["no"].to_numpy()[b], "upper": upper[a, b]})

    p, q = in_blocks(points.select("no", "vec_id", "cells"), queries, n_points, n_queries)
    floors = p.cogroup(q).applyInPandas(least, "q_no bigint, floor double").groupBy("q_no").agg(F.max("floor").alias("floor"))
    known = save(queries.join(floors, "q_no", "left"))
    p, q = in_blocks(points.select("no", "vec_id", "cells"), known, n_points, n_queries)
    pairs = save(p.cogroup(q).applyInPandas(reaching, "q_no bigint, no bigint, upper double"))
    first = scored(limited(pairs, ["q_no"], [F.desc("upper"), "no"], 4 * k).select("q_no", "no"), points, queries)
    sure = limited(first, ["q_no"], [F.desc("score"), "vec_id"], k).groupBy("q_no").agg(F.min("score").alias("kth"), F.count(F.lit(1)).alias("n"))
    rest = pairs.join(sure.filter(F.col("n") >= k).select("q_no", "kth"), "q_no", "left").filter("kth IS NULL OR upper >= kth")
    order = Window.partitionBy("q_no").orderBy(F.desc("score"), "vec_id")
    return scored(rest.select("q_no", "no"), points, queries).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
