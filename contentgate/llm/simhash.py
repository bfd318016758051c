"""SimHash near-duplicates through pigeonhole blocks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contentgate.llm.common import chunk_pairs, components, map_texts, save, spanning, whole_groups

SEED = 42
CHUNK = 2048


def fingerprint(text: str, words_per_shingle: int) -> int:
    """64-bit SimHash of the shingles, repeats included, as a signed integer; 0 without words."""
    words = text.encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    k = min(words_per_shingle, len(words))
    ends = list(accumulate(len(w) + 1 for w in words))
    joined = b" ".join(words)
    starts = [0, *ends]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    n = len(words) - k + 1
    for at in range(0, n, 1 << 16):
        hashes = np.array([digest(joined[a:b - 1], SEED) for a, b in zip(starts[at:min(n, at + (1 << 16))], ends[at + k - 1:])], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<i8")[0])


def block_keys(fp: Column, max_bits: int) -> list[Column]:
    """Keys of which two fingerprints within `max_bits` share at least one: the fingerprint is cut into
    max_bits + 2 blocks, at least two of which are free of differences, and a key holds two blocks."""
    n = max_bits + 2
    cuts = [64 * i // n for i in range(n + 1)]
    block = [F.shiftrightunsigned(fp, cuts[i]).bitwiseAND(F.lit((1 << (cuts[i + 1] - cuts[i])) - 1)) for i in range(n)]
    return [
        F.shiftleft(block[i], 40).bitwiseOR(F.shiftleft(block[j], 16)).bitwiseOR(F.lit(k).cast("bigint"))
        for k, (i, j) in enumerate(combinations(range(n), 2))
    ]


def near_pairs(group: np.ndarray, fp: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of one group within `max_bits`; `group` is sorted. Compares each row with the one d places on."""
    at, step, held = np.arange(len(fp)), 1, []
    while at.size:
        at = at[: np.searchsorted(at, len(fp) - step)]
        at = at[group[at] == group[at + step]]
        hit = at[np.bitwise_count(fp[at] ^ fp[at + step]) <= max_bits]
        held.append((hit, hit + step))
        step += 1
        if sum(len(a) for a, _ in held) > 1 << 20 or len(held) > 256:
            yield tuple(map(np.concatenate, zip(*held)))
            held = []
    if held:
        yield tuple(map(np.concatenate, zip(*held)))


def links(classes: DataFrame, max_bits: int) -> DataFrame:
    """Edges (a, b) between the representatives `rep` of distinct fingerprints `fp` that join the same components as
    all links do. Every pair that shares a block key is compared; a task passes on a spanning forest of its links, so
    a dense group never comes out as pairs."""
    if not 1 <= max_bits <= 4:
        raise ValueError("block keys are laid out for 1 to 4 differing bits")
    keyed = classes.select("fp", "rep", F.explode(F.array(*block_keys(F.col("fp"), max_bits))).alias("_key"))
    dealt = chunk_pairs(keyed, ["_key"], "fp", CHUNK)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["_key", "_pair"]):
            key, pair = table.column("_key").to_numpy(), table.column("_pair").to_numpy()
            fp, rep = table.column("fp").to_numpy().view(np.uint64), table.column("rep").to_numpy()
            group = np.concatenate([[0], np.cumsum((key[1:] != key[:-1]) | (pair[1:] != pair[:-1]))])
            root = spanning(len(fp), near_pairs(group, fp, max_bits), np.argsort(rep, kind="stable"))
            moved = np.flatnonzero(rep != rep[root])
            edges = np.unique(np.stack([rep[moved], rep[root[moved]]], axis=1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(edges[:, 0]), pa.array(edges[:, 1])], names=["a", "b"])

    return (
        dealt.select("_key", "_pair", "fp", "rep").repartition("_key", "_pair").sortWithinPartitions("_key", "_pair")
        .mapInArrow(run, "a bigint, b bigint")
    )


def near_duplicates(docs: DataFrame, words_per_shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """id, fingerprint (16 hex digits) and component_id of every row; ids are integers.

    Documents link when their fingerprints differ in at most `max_bits` bits, and component_id is the smallest id
    reachable. Equal fingerprints are one class before anything is compared, so copies cost nothing. Null and empty
    texts have fingerprint zero and link like any other. Rows that share an id share a document. A row without an id
    links nothing; it takes the component of its fingerprint, or null if no row with an id has that.
    """
    prints = save(map_texts(
        docs.select(F.col(id_col).cast("bigint").alias(id_col), F.col(text_col)), text_col, [id_col], [("fp", "bigint")],
        lambda: lambda texts: [[fingerprint(t, words_per_shingle) for t in texts]]))
    classes = save(prints.filter(F.col(id_col).isNotNull()).groupBy("fp").agg(F.min(id_col).alias("rep")))
    # an id with several texts joins their classes
    also = prints.join(classes, "fp").filter(F.col(id_col) != F.col("rep")).select(F.col(id_col).alias("a"), F.col("rep").alias("b"))
    several = prints.groupBy(id_col).agg(F.min("fp").alias("_l"), F.max("fp").alias("_h")).filter("_l <> _h")
    also = also.join(several.select(F.col(id_col).alias("a")), "a", "left_semi")
    found = components(links(classes, max_bits).union(also))
    named = classes.join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
        "fp", F.coalesce("component", "rep").alias("component_id"))
    return prints.join(named, "fp", "left").select(
        F.col(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, words_per_shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of `docs` for each group of near-duplicates: that with the smallest id (rows without one come last), and of
    equal ids the one that comes first in the saved table.

    Groups are of rows, not of ids: unrelated texts under one id stay, copies without an id are dropped like any others.
    Null and empty texts are near-duplicates of each other. Rows and fingerprints are saved once and read from there.
    """
    numbered = docs.withColumn("_no", F.monotonically_increasing_id())
    rows = save(map_texts(numbered, text_col, numbered.columns, [("_fp", "bigint")], lambda: lambda texts: [[fingerprint(t, words_per_shingle) for t in texts]]))
    first = F.min(F.struct(F.col(id_col).isNull().alias("late"), F.col(id_col).alias("id"), F.col("_no").alias("no"))).alias("first")
    classes = save(rows.groupBy(F.col("_fp").alias("fp")).agg(first).select("fp", F.col("first.no").alias("rep"), "first"))
    found = components(links(classes.select("fp", "rep"), max_bits))
    named = classes.join(found.withColumnRenamed("node", "rep"), "rep", "left").groupBy(F.coalesce("component", "rep").alias("component"))
    kept = named.agg(F.min("first").alias("first")).select(F.col("first.no").alias("_no"))
    return rows.join(kept, "_no", "left_semi").select(docs.columns)
