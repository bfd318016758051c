"""What several operators share: saved tables, text columns through Arrow, groups in blocks, components."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contentgate.session import configure, shared_dir

SALTS = 64

ARROW = {
    "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(),
    "binary": pa.binary(), "array<double>": pa.list_(pa.float64()),
}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{table}.parquet")


_WRITTEN: list[list[str]] = []


def save(df: DataFrame) -> DataFrame:
    """Write a frame to the shared folder and read it back. The lineage ends at files that every
    executor sees, so a lost executor repeats single tasks, and each value is computed once."""
    path = shared_dir(df.sparkSession)
    for paths in _WRITTEN:
        paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def passing_tables(spark: SparkSession) -> Iterator[list[str]]:
    """Tables saved inside are removed at the end, but for those taken off the list of paths that this gives."""
    paths: list[str] = []
    _WRITTEN.append(paths)
    try:
        yield paths
    finally:
        _WRITTEN.remove(paths)
        remove(spark, paths)


def remove(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete folders wherever Spark's own file systems hold them."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def small_batches(df: DataFrame) -> DataFrame:
    """Texts can be long: hand them to Python in batches of fewer rows than Spark's default."""
    key, rows = "spark.sql.execution.arrow.maxRecordsPerBatch", "1000"
    if df.sparkSession.conf.get(key) != rows:
        df.sparkSession.conf.set(key, rows)
    return df


def map_texts(df: DataFrame, text: str, keep: list[str], fields: list[tuple[str, str]],
              make: Callable[[], Callable[[list[str]], list]]) -> DataFrame:
    """`keep` columns unchanged plus `fields`, computed from whole texts (null counts as empty).

    `make` runs once per task and returns a function from a batch of texts to one list per field.
    """
    types = [df.schema[c].dataType.simpleString() for c in keep]
    schema = ", ".join(f"`{n}` {t}" for n, t in [*zip(keep, types), *fields])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            made = [pa.array(c, ARROW[t]) for c, (_, t) in zip(fn(texts), fields)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *made], names=[*keep, *(n for n, _ in fields)])

    return small_batches(df).select(F.col(text).cast("string").alias("_text"), *keep).mapInArrow(run, schema)


def whole_groups(batches: Iterable[pa.RecordBatch], keys: list[str], rows: int = 1 << 16) -> Iterator[pa.Table]:
    """Cut a partition sorted by `keys` into tables of complete groups, about `rows` rows or one group each."""
    held: list[pa.RecordBatch] = []
    n = 0

    def cut(table: pa.Table) -> tuple[pa.Table, pa.Table]:
        last = np.ones(table.num_rows, dtype=bool)
        for k in keys:
            col = table.column(k).to_numpy()
            last &= col == col[-1]
        at = table.num_rows - int(last[::-1].argmin() if not last.all() else table.num_rows)
        return table.slice(0, at), table.slice(at)

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            done, rest = cut(pa.Table.from_batches(held))
            if done.num_rows:
                yield done
            held, n = rest.combine_chunks().to_batches(), rest.num_rows
            if n >= rows:  # a group larger than a block: look again only after it has doubled
                rows = 2 * n
    if n:
        yield pa.Table.from_batches(held)


def chunk_pairs(df: DataFrame, keys: list[str], member: str, size: int) -> DataFrame:
    """Deal the rows of each key into tasks (`keys`, `_pair`) of at most about 2 x `size` rows such that any
    two rows of a key meet in one task. A key with a single row is left out: it meets nobody. `_same` marks the rows
    of the tasks that are a single chunk's own.

    Rows of a key are hashed into ceil(rows / size) chunks (`_own`) and a task holds one or two chunks, so a key of
    any size is shared by many tasks; rows of one chunk also meet in tasks that hold another chunk. Keys are counted with partial sums; no task sees a whole large key.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    dealt = df.join(counts, keys).withColumn("_c", F.ceil(F.col("_n") / size).cast("int"))
    dealt = dealt.withColumn("_own", F.pmod(F.xxhash64(member), F.col("_c")).cast("int"))
    own, n = F.col("_own"), F.col("_c")
    pairs = F.transform(F.sequence(F.lit(0), n - 1), lambda x: F.least(own, x) * n + F.greatest(own, x))
    return dealt.withColumn("_pair", F.explode(pairs)).withColumn("_same", F.col("_pair") == own * (n + 1)).drop("_n", "_c")


def spanning(n: int, pairs: Iterable[tuple[np.ndarray, np.ndarray]], order: np.ndarray) -> np.ndarray:
    """Index of the smallest member (by `order`) of each row's component, for links given as index arrays."""
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.arange(n)
    label = np.arange(n)
    for a, b in pairs:
        a, b = rank[a], rank[b]
        while True:
            low = np.minimum(label[a], label[b])
            if (label[a] == low).all() and (label[b] == low).all():
                break
            np.minimum.at(label, label[a], low)
            np.minimum.at(label, label[b], low)
            while (label != label[label]).any():
                label = label[label]
    return order[label[rank]]


def with_lowest(pairs: DataFrame, lowest: DataFrame, edges: int) -> DataFrame:
    """`pairs` (u, v) joined with `lowest` (u, m, n), n being the pairs of u. The rows of a u with more than a thousandth of
    all pairs (two thousand such u at most) are spread over SALTS tasks."""
    hub = F.col("n") > max(256, edges // 1000)
    hubs = lowest.filter(hub).select("u", F.lit(True).alias("_hub"))
    salted = pairs.join(F.broadcast(hubs), "u", "left").withColumn("_salt", F.when(F.col("_hub"), F.pmod(F.xxhash64("v"), F.lit(SALTS))).otherwise(F.lit(0)).cast("int"))
    every = F.when(hub, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return salted.join(lowest.select("u", "m", F.explode(every).alias("_salt")), ["u", "_salt"]).select("u", "v", "m")


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over `edges` (columns a, b), for nodes with an edge.

    Alternates large-star and small-star steps until every edge points at its component's smallest node.
    Edges stay in tables throughout, and each step writes its table to the shared folder. No node's edges need fit one task.
    """
    e = save(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        n = e.count()
        many = e.groupBy("a").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
        if not n or many.isEmpty() and e.join(e.select(F.col("b").alias("a")).distinct(), "a", "left_semi").isEmpty():
            break
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a"))
        low = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        large = with_lowest(both, save(low), n).filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        large = save(large)
        low = save(large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")))
        hung = with_lowest(large.select(F.col("a").alias("u"), F.col("b").alias("v")), low.filter("n > 1"), n).filter("v <> m")
        e = save(hung.select(F.col("v").alias("a"), F.col("m").alias("b")).union(low.select("u", "m")).distinct())
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        e.select(F.col("b"), F.col("b")).distinct())
