"""Exact removal of repeated byte strings: suffix buckets with difference-cover ranks.

Two strings that are equal over `length` bytes are, at some shift below the period v, both at positions of a difference
cover of v. So the suffixes at cover positions are ranked first, in buckets that are each sorted by one task: by the
length - v + 1 bytes that follow (depth 1), and, where those repeat, by everything that decides all shifts at once
(depth 2: v - 1 bytes before and `length` after). Ranks settle the long ties: a cover suffix that repeats at depth 2 makes
every suffix within v before it a repeat without sorting it, and a suffix with no cover suffix that repeats at
depth 1 behind it is none. Only the suffixes left, near the ends of repeats, are dealt into buckets of their own and
sorted there, one bucket at a time, together with one copy of the settled ones that share a depth-1 rank with them.

Ranks are fingerprints of the bytes they stand for: order among suffixes is of no use here, equality is.
"""

from __future__ import annotations

import math
import uuid
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contentgate.llm.common import save, small_batches
from contentgate.session import shared_dir

PRIME = 13
UNIT_BYTES = 2 << 20
BUCKET_BYTES = 4 << 20
TILE = 1 << 20
BASE = 0x9E3779B97F4A7C15


@cache
def difference_cover(q: int = PRIME) -> tuple[int, tuple[int, ...]]:
    """Period v = q^2 + q + 1 and a perfect difference set of q + 1 residues, for a prime q (Singer): the powers of a
    generator of the cubic extension that lie in one plane."""
    v = q * q + q + 1
    for a in range(q):
        for b in range(q):
            for c in range(1, q):
                x, plane, ok = (1, 0, 0), [], True
                for i in range(v):
                    if i and x[1] == x[2] == 0:
                        ok = False
                        break
                    if x[2] == 0:
                        plane.append(i)
                    x = (c * x[2] % q, (x[0] + b * x[2]) % q, (x[1] + a * x[2]) % q)
                if ok and len({(i - j) % v for i in plane for j in plane}) == v:
                    return v, tuple(plane)
    raise ValueError(f"no cover for {q}")


@cache
def powers(longest: int) -> tuple[np.ndarray, ...]:
    """For two independent sums: a random number per byte value, and the powers of the base and of its inverse."""
    rng = np.random.default_rng(7)
    out = []
    for base in (BASE, BASE ^ 0x5DEECE66D6):
        base |= 1
        steps = []
        for factor in (base, pow(base, -1, 1 << 64)):
            step = np.full(TILE + longest + 1, factor, dtype=np.uint64)
            step[0] = 1
            steps.append(np.cumprod(step, dtype=np.uint64))
        out += [rng.integers(0, 1 << 64, 256, dtype=np.uint64), *steps]
    return tuple(out)


def fingerprints(data: np.ndarray, at: np.ndarray, length: int, sums: int = 2) -> list[np.ndarray]:
    """Fingerprints of the `length` bytes from each of the sorted positions `at`; memory is bounded by TILE."""
    table = powers(1 << 10)
    out = [np.empty(len(at), dtype=np.uint64) for _ in range(sums)]
    for start in range(0, len(data), TILE):
        i, j = np.searchsorted(at, [start, start + TILE])
        if i == j:
            continue
        part, local = data[start:start + TILE + length], at[i:j] - start
        for k in range(sums):
            byte, up, down = table[3 * k:3 * k + 3]
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(byte[part] * up[: len(part)], dtype=np.uint64)])
            out[k][i:j] = (total[local + length] - total[local]) * down[local]
    return out


class Entries:
    """The distinct fingerprints of one unit, in order, cut into buckets by their leading bits."""

    def __init__(self, prints: list[np.ndarray], bits: int, open_: np.ndarray | None = None):
        self.values, self.first, self.index, count = np.unique(prints[0], return_index=True, return_inverse=True, return_counts=True)
        self.second = prints[1][self.first] if len(prints) > 1 else None
        self.twice, self.bits, self.open = count > 1, bits, None
        if open_ is not None:
            self.open = np.zeros(len(self.values), dtype=bool)
            self.open[self.index[open_]] = True
        edges = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.empty(0, np.uint64)
        self.cuts = np.concatenate([[0], np.searchsorted(self.values, edges), [len(self.values)]])

    def slices(self):
        """(bucket, bytes): for ranks that are confirmed later 32 bits an entry, otherwise 96."""
        for bucket, (i, j) in enumerate(zip(self.cuts, self.cuts[1:])):
            if i < j:
                if self.second is None:
                    flags = b"" if self.open is None else np.packbits(self.open[i:j]).tobytes()
                    yield bucket, (self.values[i:j] >> np.uint64(32 - min(32, self.bits))).astype("<u4").tobytes() + flags
                else:
                    yield bucket, self.values[i:j].astype("<u8").tobytes() + self.second[i:j].astype("<u4").tobytes()

    def marked(self, masks, name: str, flag: np.ndarray) -> np.ndarray:
        """`flag` of the entries or-ed with what the buckets' masks say."""
        for m in masks if masks is not None else ():
            if m[name] is not None:
                i, j = self.cuts[m["bucket"]], self.cuts[m["bucket"] + 1]
                flag[i:j] |= np.unpackbits(np.frombuffer(m[name], np.uint8), count=j - i).astype(bool)
        return flag

    def repeated(self, masks) -> np.ndarray:
        """Which of the original positions repeat, here or in another unit."""
        return self.marked(masks, "mask", self.twice.copy())[self.index]

    def leading(self, masks) -> np.ndarray:
        """One original position of each repeated fingerprint: here, unless another unit holds the leading one."""
        later = self.marked(masks, "later", np.zeros(len(self.values), dtype=bool))
        return np.sort(self.first[self.marked(masks, "mask", self.twice.copy()) & ~later])

    def with_open(self, masks) -> np.ndarray:
        """Which of the original positions share their fingerprint with an open one, here or in another unit."""
        return self.marked(masks, "mask", self.open.copy())[self.index]


def sort_buckets(entries: DataFrame, kind: str) -> DataFrame:
    """unit and, per bucket, masks of its entries that another unit holds too, and of those for which another unit
    leads; for the kind "open", of its entries that are open in some unit. `entries`: unit, bucket, blob."""
    def one(frame: pd.DataFrame) -> pd.DataFrame:
        blobs = list(frame["blob"])
        # "open" has a bit an entry behind the values
        sizes = np.array([len(b) * 8 // {"narrow": 32, "wide": 96, "open": 33}[kind] for b in blobs])
        if kind == "wide":
            value = np.concatenate([np.frombuffer(b, "<u8", n) for b, n in zip(blobs, sizes)])
            second = np.concatenate([np.frombuffer(b, "<u4", n, 8 * n) for b, n in zip(blobs, sizes)])
            order = np.lexsort((second, value))
            same = (value[order][1:] == value[order][:-1]) & (second[order][1:] == second[order][:-1])
        else:
            value = np.concatenate([np.frombuffer(b, "<u4", n) for b, n in zip(blobs, sizes)])
            order = np.argsort(value, kind="stable")
            same = value[order][1:] == value[order][:-1]
        twice = np.zeros(len(value), dtype=bool)
        later = np.zeros(len(value), dtype=bool)
        later[order[1:][same]] = True
        twice[order[:-1][same]] = True
        twice |= later
        if kind == "open":
            flags = np.concatenate([np.unpackbits(np.frombuffer(b, np.uint8, offset=4 * n), count=n) for b, n in zip(blobs, sizes)])
            group = np.concatenate([[0], np.cumsum(~same)])
            twice[order] = np.bincount(group, flags[order])[group] > 0
        cut = lambda flag: [np.packbits(flag[b - n:b]).tobytes() for b, n in zip(np.cumsum(sizes), sizes)]
        masks = pd.DataFrame({"unit": frame["unit"], "bucket": frame["bucket"], "mask": cut(twice), "later": cut(later)})
        return masks[[m.strip(b"\0") != b"" for m in masks["mask"]]]

    found = entries.groupBy("bucket").applyInPandas(one, "unit bigint, bucket int, mask binary, later binary")
    return save(found.groupBy("unit").agg(F.collect_list(F.struct("bucket", "mask", "later")).alias("masks")))


class Unit:
    """Some documents end to end, and what the ranks found so far say about their suffixes."""

    def __init__(self, data: bytes, ends, length: int, bits: int):
        self.data, self.ends = np.frombuffer(data, np.uint8), np.asarray(ends, dtype=np.int64)
        self.length, self.bits = length, bits
        self.v, cover = difference_cover()
        self.starts = np.concatenate([[0], self.ends[:-1]])
        n = len(self.data)
        at = (np.arange(0, n + self.v, self.v)[:, None] + np.array(cover)).ravel()
        self.at = self.inside(at[at < n], 0, length - self.v + 1)

    def inside(self, at: np.ndarray, before: int, after: int) -> np.ndarray:
        """Positions whose surroundings lie in one document."""
        doc = np.searchsorted(self.ends, at, side="right")
        return at[(at - before >= self.starts[doc]) & (at + after <= self.ends[doc])] if len(at) else at

    def depth1(self) -> Entries:
        return Entries(fingerprints(self.data, self.at, self.length - self.v + 1, 1), self.bits)

    def depth2(self, masks1) -> Entries:
        self.often = self.at[self.depth1().repeated(masks1)]
        self.deep = self.inside(self.often, self.v - 1, self.length)
        return Entries(fingerprints(self.data, self.deep - (self.v - 1), self.length + self.v - 1), self.bits)

    def covered(self, at: np.ndarray) -> np.ndarray:
        """All suffixes up to v - 1 before the given cover suffixes; one byte a suffix, counts stay below v."""
        change = np.zeros(len(self.data) + 1, dtype=np.int16)
        np.add.at(change, np.maximum(at - (self.v - 1), 0), 1)
        np.add.at(change, at + 1, -1)
        return np.cumsum(change[:-1], dtype=np.int16) > 0

    def classes(self, masks1, masks2) -> Entries:
        """Depth-1 ranks of the cover suffixes that depth 2 left open, and of the leading settled ones."""
        ranked = self.depth2(masks1)
        settled = self.deep[ranked.repeated(masks2)]
        self.known, self.leads = self.covered(settled), self.deep[ranked.leading(masks2)]
        self.unsettled = np.setdiff1d(self.often, settled, assume_unique=True)
        self.both = np.union1d(self.unsettled, self.leads)
        return Entries(fingerprints(self.data, self.both, self.length - self.v + 1, 1), self.bits, np.isin(self.both, settled, invert=True))

    def depth3(self, masks1, masks2, masks_open) -> Entries:
        # An open suffix equals one before an unsettled cover suffix, or one before a settled one of the same depth-1 rank: of
        # equal surroundings one leads, and its suffixes are sorted too.
        near_open = self.classes(masks1, masks2).with_open(masks_open)
        led = self.covered(np.intersect1d(self.both[near_open], self.leads, assume_unique=True))
        self.open = self.inside(np.flatnonzero(self.covered(self.unsettled) | led), 0, self.length)
        return Entries(fingerprints(self.data, self.open, self.length), self.bits)

    def removed(self, masks1, masks2, masks_open, masks3) -> list[tuple[bytes, list[int]]]:
        """Per document the kept bytes and the removed runs, start and end in turn."""
        entries = self.depth3(masks1, masks2, masks_open)
        self.known[self.open[entries.repeated(masks3)]] = True
        edge = np.flatnonzero(np.diff(np.concatenate([[False], self.known, [False]]).astype(np.int8)))
        first, last = edge[::2], edge[1::2] - 1 + self.length
        # runs that touch are one, but not across documents
        doc = np.searchsorted(self.ends, first, side="right")
        new = np.ones(len(first), dtype=bool)
        new[1:] = (first[1:] > last[:-1]) | (doc[1:] != doc[:-1])
        first, doc = first[new], doc[new]
        last = last[np.concatenate([new[1:], [True]])] if len(last) else last
        out, raw = [], memoryview(self.data)
        cut = np.searchsorted(doc, np.arange(len(self.ends) + 1))
        for d, (start, end) in enumerate(zip(self.starts, self.ends)):
            runs, kept, at = [], [], start
            for a, b in zip(first[cut[d]:cut[d + 1]], last[cut[d]:cut[d + 1]]):
                kept.append(raw[at:a])
                runs += [int(a - start), int(b - start)]
                at = b
            out.append((b"".join([*kept, raw[at:end]]), runs))
        return out


def units_of(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """The texts as UTF-8 in units of about UNIT_BYTES, in a table bucketed by unit so that results about units come
    back to them without moving the texts again; and the number of bytes."""
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()

    def packed(batches):
        base, number = TaskContext.get().partitionId() << 32, 0
        ids, parts, size = [], [], 0

        def unit():
            nonlocal ids, parts, size, number
            ends = np.cumsum([len(p) for p in parts])
            row = pa.RecordBatch.from_arrays([
                pa.array([base + number]), pa.array([pa.concat_arrays(ids).to_pylist()], pa.list_(ids[0].type)), pa.array([ends.tolist()], pa.list_(pa.int64())),
                pa.array([b"".join(parts)], pa.binary())], names=["unit", "ids", "ends", "data"])
            ids, parts, size, number = [], [], 0, number + 1
            return row

        for batch in batches:
            for k, text in enumerate(batch.column(1).cast(pa.binary()).to_pylist()):
                ids.append(batch.column(0).slice(k, 1))
                parts.append(text or b"")
                size += len(parts[-1])
                if size >= UNIT_BYTES:
                    yield unit()
        if parts:
            yield unit()

    made = small_batches(docs).select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(packed, f"unit bigint, ids array<{kind}>, ends array<bigint>, data binary")
    path, name = shared_dir(spark), f"units_{uuid.uuid4().hex}"
    sizes = docs.agg(F.sum(F.octet_length(text_col)).alias("n")).first()["n"] or 0
    made.write.bucketBy(max(1, min(1 << 16, math.ceil(sizes / (8 * UNIT_BYTES)))), "unit").option("path", path).saveAsTable(name)
    units = spark.table(name)
    units.schema  # resolved: the frame knows its files and buckets, the catalog's entry has served
    spark.sql(f"DROP TABLE {name}")
    return units, sizes


def remove_repeats(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, spans (removed runs, start and end in turn) and kept (remaining bytes) of every row.

    Removed is every byte covered by a string of `length` bytes that starts at another place too, in the same or another
    row, judged on the input: all copies go. Strings do not cross rows. Null and empty texts have no bytes; rows shorter
    than `length` are kept; repeated rows remove each other; null and repeated ids are passed through.
    """
    v, _ = difference_cover()
    if not v <= length <= 700:
        raise ValueError("length must be at least the cover's period")
    units, size = units_of(docs, id_col, text_col)
    bits = max(0, math.ceil(math.log2(max(1, size / BUCKET_BYTES))))
    kind = docs.schema[id_col].dataType.simpleString()
    masks: list[DataFrame] = []

    def joined() -> DataFrame:
        out = units
        for k, m in enumerate(masks):
            out = out.join(m.withColumnRenamed("masks", f"m{k}"), "unit", "left")
        return out

    def each(step):
        """Run `step(unit, row)` over the rows of a task, one unit at a time."""
        def run(batches):
            for batch in batches:
                for k in range(batch.num_rows):
                    row = {name: batch.column(name)[k].as_py() for name in batch.schema.names}
                    found = [row.get(f"m{i}") for i in range(4)]
                    yield from step(Unit(row["data"], row["ends"], length, bits), row, found)

        return run

    def emit(entries_of):
        def step(unit, row, found):
            slices = list(entries_of(unit, found).slices())
            if slices:
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["unit"]] * len(slices)), pa.array([b for b, _ in slices], pa.int32()), pa.array([s for _, s in slices], pa.binary())],
                    names=["unit", "bucket", "blob"])

        return each(step)

    depths = (
        ("narrow", lambda u, m: u.depth1()), ("wide", lambda u, m: u.depth2(m[0])), ("open", lambda u, m: u.classes(m[0], m[1])),
        ("wide", lambda u, m: u.depth3(m[0], m[1], m[2])))
    for k, (kind_of, entries_of) in enumerate(depths):
        columns = ["unit", "ends", "data", *(f"m{i}" for i in range(k))]
        masks.append(sort_buckets(joined().select(columns).mapInArrow(emit(entries_of), "unit bigint, bucket int, blob binary"), kind_of))

    def result(unit, row, found):
        both = unit.removed(*found)
        yield pa.RecordBatch.from_arrays([
            pa.array(row["ids"], ids_type), pa.array(np.diff(unit.ends, prepend=0)),
            pa.array([runs for _, runs in both], pa.list_(pa.int64())), pa.array([kept for kept, _ in both], pa.binary())],
            names=[id_col, "n_bytes", "spans", "kept"])

    ids_type = docs.select(id_col).limit(0).toArrow().schema.field(0).type
    return joined().mapInArrow(each(result), f"`{id_col}` {kind}, n_bytes bigint, spans array<bigint>, kept binary")
