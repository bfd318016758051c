"""A Merkle manifest of a dataset, built from SHA-256 states that parents retain.

A parent's digest is one hash over its children in turn, and the parent keeps a copy of the hash state from before each
child's slot. To fold a changed child, its parent resumes the state of that slot and takes in the replacement and the
children to its right only; what lies to the left is in the state already.

The leaves are numbered through one range-partitioned sort. Aligned runs of `SIZE` nodes are a task's work: tables of
subtree roots go up, each 1 / SIZE of the one below, then the siblings on the way to the root come down again, one row
per subtree. Texts are read once; what moves are digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contentgate.llm.common import save

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 2
SIZE = 4096  # nodes of a subtree, a power of ARITY


def leaf_of(values: Mapping[str, Column], fields: tuple[str, ...]) -> Column:
    """Lower-case hex SHA-256 over the fields in turn: `-` for null, else UTF-8 byte count, `:` and the value."""
    parts = []
    for name in fields:
        value = values[name].cast("string")
        parts.append(F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.sha2(F.concat(*parts), 256)


def height(n: int) -> int:
    """Levels of a tree with n leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


class Subtree:
    """Some levels over neighbouring nodes, with the retained states."""

    def __init__(self, nodes: list[str], levels: int):
        self.levels = [nodes]
        self.states: list[list[list]] = []
        for _ in range(levels):
            below, row, states = self.levels[-1], [], []
            for at in range(0, len(below), ARITY):
                state, before = hashlib.sha256(), []
                for child in below[at:at + ARITY]:
                    before.append(state.copy())
                    state.update(child.encode())
                states.append(before)
                row.append(state.hexdigest())
            self.levels.append(row)
            self.states.append(states)

    def fold(self, at: int, node: str) -> str:
        """The top digest with the leaf at a place replaced."""
        for below, states in zip(self.levels, self.states):
            parent, slot = divmod(at, ARITY)
            state = states[parent][slot].copy()
            state.update(node.encode())
            for right in below[at + 1:(parent + 1) * ARITY]:
                state.update(right.encode())
            at, node = parent, state.hexdigest()
        return node

    def siblings(self, at: int) -> list[tuple[str, str]]:
        """Level by level the digests to the left and to the right in the same run, joined."""
        out = []
        for below in self.levels[:-1]:
            parent = at // ARITY
            out.append(("".join(below[parent * ARITY:at]), "".join(below[at + 1:(parent + 1) * ARITY])))
            at = parent
        return out


def written(path: list[tuple[str, str]]) -> str:
    return "".join(f"{left}<{right};" for left, right in path)


def parsed(path: str) -> list[tuple[str, str]]:
    return [tuple(step.split("<")) for step in path.split(";")[:-1]]


class Ascent:
    """The way from a subtree's top to the root, with the state before its slot at each level."""

    def __init__(self, path: str):
        self.steps = []
        for left, right in parsed(path):
            state = hashlib.sha256()
            state.update(left.encode())
            self.steps.append((state, right.encode()))

    def fold(self, node: str) -> str:
        for before, right in self.steps:
            state = before.copy()
            state.update(node.encode())
            state.update(right)
            node = state.hexdigest()
        return node


def subtree(frame: pd.DataFrame, size: int) -> tuple[pd.DataFrame, Subtree]:
    """A run's rows in order, and its tree: to the run's single top, or to the single node of a smaller group."""
    frame = frame.sort_values("idx", kind="stable")
    return frame, Subtree(frame["hash"].tolist(), height(min(int(frame["n"].iloc[0]), size)))


def climb(nodes: DataFrame, most: int, size: int) -> list[DataFrame]:
    """Tables (g, n, idx, hash), the first one given, with n the nodes of the group and idx their order; each following one
    holds the tops of runs of `size` nodes, and the last one a single node per group. `most`: nodes of the largest group."""
    def tops(frame: pd.DataFrame) -> pd.DataFrame:
        frame, tree = subtree(frame, size)
        n = int(frame["n"].iloc[0])
        return pd.DataFrame({"g": frame["g"].iloc[:1], "n": [-(-n // size)], "idx": [int(frame["idx"].iloc[0]) // size], "hash": [tree.levels[-1][0]]})

    tables = [nodes]
    while most > 1 or len(tables) == 1:
        runs = tables[-1].select("g", "n", "idx", "hash", F.floor(F.col("idx") / size).alias("run"))
        tables.append(save(runs.groupBy("g", "run").applyInPandas(tops, "g bigint, n bigint, idx bigint, hash string")))
        most = -(-most // size)
    return tables


def descend(tables: list[DataFrame], above: DataFrame, size: int) -> DataFrame:
    """(g, idx, path) of the nodes of the second table: siblings up to their group's top, then `above` (g, idx = 0, path)."""
    def paths(frame: pd.DataFrame, parent: pd.DataFrame) -> pd.DataFrame:
        frame, tree = subtree(frame, size)
        rest = parent["path"].iloc[0]
        return pd.DataFrame({"g": frame["g"], "idx": frame["idx"], "path": [written(tree.siblings(k)) + rest for k in range(len(frame))]})

    found = above
    for nodes in reversed(tables[1:-1]):
        left = nodes.withColumn("run", F.floor(F.col("idx") / size)).groupBy("g", "run")
        right = found.withColumnRenamed("idx", "run").groupBy("g", "run")
        found = save(left.cogroup(right).applyInPandas(paths, "g bigint, idx bigint, path string"))
    return found


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """`rows` with `g` (rank of their group, null first) and `n` (its rows) and `idx` (order within it, from 0).

    One range-partitioned sort over all columns that decide the order; then only counts per (partition, group) are
    added up. `order` must tell all rows apart that differ.
    """
    sort = [group, *order]
    placed = save(rows.repartitionByRange(*sort).sortWithinPartitions(*sort).select(
        "*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_pos")))
    spans = placed.groupBy("_part", group).agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_count"))
    within = Window.partitionBy(group).orderBy("_part")  # at most one row per partition and group
    spans = save(spans.select(
        "*", F.sum("_count").over(Window.partitionBy(group)).alias("n"),
        (F.sum("_count").over(within) - F.col("_count")).alias("_before")))
    heads = spans.filter("_before = 0").select(group, "_part", "_first")
    ranks = ranked_groups(heads, group).withColumnRenamed(group, "_group")
    spans = spans.join(ranks, F.col(group).eqNullSafe(F.col("_group"))).select(
        F.col("_part").alias("_p"), "_group", "g", "n", (F.col("_before") - F.col("_first")).alias("_shift"))
    return placed.join(spans, (F.col("_part") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_group"))).withColumn(
        "idx", F.col("_pos") + F.col("_shift")).drop("_part", "_pos", "_p", "_group", "_shift")


def ranked_groups(heads: DataFrame, group: str) -> DataFrame:
    """(group, g): groups in the order of their first rows. Ranks within each partition, then the partitions' counts."""
    inside = Window.partitionBy("_part").orderBy("_first")
    parts = heads.groupBy("_part").agg(F.count(F.lit(1)).alias("_k"))
    before = parts.select("_part", (F.sum("_k").over(Window.orderBy("_part")) - F.col("_k")).alias("_b"))  # a row per partition
    return heads.withColumn("_r", F.row_number().over(inside)).join(before, "_part").select(group, (F.col("_b") + F.col("_r") - 1).alias("g"))


def manifest(docs: DataFrame, now: Callable[[DataFrame], Mapping[str, Column]] | None = None, fields: tuple[str, ...] = FIELDS,
             id_col: str = "doc_id", group_col: str = "lang", size: int = SIZE, proofs: bool = True) -> DataFrame:
    """id, group, leaf, subroot, root, proof (siblings to the root as `left<right;` per level), proof_sha256, now_leaf,
    folded_root and verified for every row of `docs`.

    The rows of each group, by id and then by leaf, are the leaves of its subroot; subroots by group, null first, are the
    leaves of the root. Runs of two nodes become their hash, a single last one too, while several remain; a lone node stays
    as it is. `now(docs)` may name columns for the present values of fields: the row's leaf is then computed anew and
    folded along the recorded siblings, and `verified` says whether that gives the root. Without `proofs` the column
    proof is null: it is as long as a short text.

    Null and repeated ids, null and repeated rows are leaves like any other (null ids first; equal rows are
    interchangeable and sorted apart by a saved number, so copies spread over tasks). An empty table gives no rows.
    """
    recorded = {name: F.col(name) for name in fields}
    present = recorded | dict(now(docs) if now else {})
    rows = save(docs.select(
        F.col(id_col).alias("_id"), F.col(group_col).alias("_lang"), leaf_of(recorded, fields).alias("hash"),
        leaf_of(present, fields).alias("now_leaf"), F.monotonically_increasing_id().alias("_row")))
    leaves = save(numbered(rows, "_lang", ["_id", "hash", "_row"]))
    largest = leaves.agg(F.max("n"), F.max("g")).first()
    kind = docs.schema[id_col].dataType.simpleString(), docs.schema[group_col].dataType.simpleString()
    trees = climb(leaves, largest[0] or 0, size)
    subroots = trees[-1].select(F.lit(0).cast("bigint").alias("g"), F.lit((largest[1] or 0) + 1).cast("bigint").alias("n"), F.col("g").alias("idx"), "hash")
    tops = climb(save(subroots), (largest[1] or 0) + 1, size)
    root = (tops[-1].first() or {"hash": None})["hash"]

    def down(frame: pd.DataFrame, parent: pd.DataFrame) -> pd.DataFrame:
        frame, tree = subtree(frame, size)
        rest = parent["path"].iloc[0]
        return pd.DataFrame({
            "g": frame["idx"], "subroot": frame["hash"], "path": [written(tree.siblings(k)) + rest for k in range(len(frame))]})

    start = tops[-1].select("g", "idx", F.lit("").alias("path"))
    over = descend(tops, start, size).withColumnRenamed("idx", "run").groupBy("g", "run")
    groups = save(tops[0].withColumn("run", F.floor(F.col("idx") / size)).groupBy("g", "run").cogroup(over).applyInPandas(
        down, "g bigint, subroot string, path string"))
    above = groups.select("g", F.lit(0).cast("bigint").alias("idx"), "path")
    paths = descend(trees, above, size).join(groups.select("g", "subroot"), "g").withColumnRenamed("idx", "run")

    def out(frame: pd.DataFrame, parent: pd.DataFrame) -> pd.DataFrame:
        frame, tree = subtree(frame, size)
        path, subroot = parent[["path", "subroot"]].iloc[0]
        ascent, above = Ascent(path), "".join(left + right for left, right in parsed(path))
        proof, digest, folded = [], [], []
        for k, leaf in enumerate(frame["now_leaf"]):
            steps = tree.siblings(k)
            proof.append(written(steps) + path if proofs else None)
            digest.append(hashlib.sha256(("".join(left + right for left, right in steps) + above).encode()).hexdigest())
            folded.append(ascent.fold(tree.fold(k, leaf)))
        return pd.DataFrame({
            id_col: frame["_id"], group_col: frame["_lang"], "leaf": frame["hash"], "subroot": subroot, "root": root, "proof": proof,
            "proof_sha256": digest, "now_leaf": frame["now_leaf"], "folded_root": folded, "verified": [f == root for f in folded]})

    schema = (f"`{id_col}` string, `{group_col}` string, leaf string, subroot string, root string, proof string, proof_sha256 string, "
              "now_leaf string, folded_root string, verified boolean")
    # ids as text: pandas would turn integers with nulls among them into floating point numbers
    runs = leaves.select("g", "n", "idx", "hash", "now_leaf", F.floor(F.col("idx") / size).alias("run"),
                         F.col("_id").cast("string").alias("_id"), F.col("_lang").cast("string").alias("_lang"))
    found = runs.groupBy("g", "run").cogroup(paths.groupBy("g", "run")).applyInPandas(out, schema)
    return found.withColumn(id_col, F.col(id_col).cast(kind[0])).withColumn(group_col, F.col(group_col).cast(kind[1]))
