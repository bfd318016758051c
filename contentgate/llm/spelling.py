"""Spelling variants: words within one edit, and the commoner form each leads to.

Every word is dealt into blocks by half of its characters such that two words within one edit share a block of the
prefix or of the suffix kind. In a block, kept sorted, the rest of each word runs against the sorted list: one banded
row of the edit matrix per prefix that neighbours in the list share (their LCPs cut the list into ranges), computed once
from the row of the range around it. A range whose band has no cell of one edit or fewer is skipped with all its words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contentgate.llm.common import chunk_pairs, save, small_batches, whole_groups

LEAST_LENGTH, LEAST_COUNT, TIMES, DIVISOR = 5, 3, 2, 97
RUN = re.compile(r"[A-Za-zÀ-ÿ]{%d,}" % LEAST_LENGTH)
LOWER = {c: c + 32 for c in range(65, 91)}
CHUNK = 20_000
QUERIES = 1 << 13
FLUSH = 200_000
FAR = 3


def occurrences(doc: str | None, text: str) -> Counter:
    """How often each word of at least LEAST_LENGTH characters occurs in one text, after the deletions."""
    out: Counter = Counter()
    lead = None if doc is None else zlib.crc32(f"{doc}:".encode())
    for run, n in Counter(RUN.findall(text)).items():
        low = run if run.islower() else run.translate(LOWER)
        if lead is not None:
            h = zlib.crc32(low.encode(), lead)
            if h % DIVISOR == 0:
                at = h % len(low)
                low = low[:at] + low[at + 1:]
                if len(low) < LEAST_LENGTH:
                    continue
        out[low] += n
    return out


def vocabulary(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(word, n): the words that occur LEAST_COUNT times at least. Tasks pass on their own sums."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def flush():
            batch = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])
            total.clear()
            return batch

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total.update(occurrences(doc, text or ""))
                if len(total) >= FLUSH:
                    yield flush()
        if total:
            yield flush()

    found = small_batches(docs).select(F.col(id_col).cast("string").alias("i"), F.col(text_col).cast("string").alias("t")).mapInArrow(run, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def blocks(words: DataFrame) -> DataFrame:
    """Rows (_key, rest, shorter, n): each word in a prefix and a suffix block as the shorter word of a pair, and in those
    of one character less as the longer one. The key names the kind, the shorter length L and the shared part: the first
    L // 2 characters, or the last L - L // 2. An edit leaves one of the two alone."""
    size = F.length("word")
    both = words.withColumn("_role", F.explode(F.when(size > LEAST_LENGTH, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    short = size - F.col("_role")
    head = F.floor(short / 2).cast("int")
    tail = short - head
    part = lambda start, length: F.substring(F.col("word"), start, length)
    one = F.struct(F.concat(F.lit("p"), short, F.lit(":"), part(F.lit(1), head)).alias("_key"), part(head + 1, size).alias("rest"))
    two = F.struct(F.concat(F.lit("s"), short, F.lit(":"), part(size - tail + 1, tail)).alias("_key"), part(F.lit(1), size - tail).alias("rest"))
    return both.select(F.explode(F.array(one, two)).alias("_b"), (F.col("_role") == 0).alias("shorter"), "n").select("_b._key", "_b.rest", "shorter", "n")


class Block:
    """Sorted strings of several groups, end to end, as code points."""

    def __init__(self, rests: list[str], group: np.ndarray):
        self.length = np.array([len(r) for r in rests], dtype=np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.flat = np.concatenate([np.frombuffer("".join(rests).encode("utf-32-le"), "<u4"), np.zeros(1, "<u4")])
        self.group = group
        n = len(rests)
        self.lcp = np.zeros(n, dtype=np.int64)
        live = np.flatnonzero(group[1:] == group[:-1]) + 1
        self.lcp[group != np.concatenate([[-1], group[:-1]])] = -1
        depth = 0
        while len(live):
            live = live[(self.length[live] > depth) & (self.length[live - 1] > depth)]
            live = live[self.char(live, depth) == self.char(live - 1, depth)]
            depth += 1
            self.lcp[live] = depth

    def char(self, word: np.ndarray, at) -> np.ndarray:
        """The character at a place of each word, zero outside."""
        ok = (at >= 0) & (at < self.length[word])
        return np.where(ok, self.flat[np.where(ok, self.start[word] + at, len(self.flat) - 1)], 0)

    def near(self, queries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, word) index pairs of one group that are exactly one edit apart.

        `row` holds, per query and range of the list, three cells of the edit matrix's row for the range's shared prefix
        of length i: against the first i - 1, i and i + 1 characters of the query.
        """
        n = len(self.length)
        first = np.flatnonzero(self.lcp < 0)
        edge = np.append(first, n)
        own = self.group[queries]
        q, lo, hi = queries, edge[own], edge[own + 1]
        row = np.tile(np.array([[FAR, 0, 1]], dtype=np.int8), (len(q), 1))
        i, tall = 0, np.arange(n)
        while len(q):
            i += 1
            tall = tall[self.length[tall] >= i]
            starts = tall[self.lcp[tall] < i]  # where a prefix of length i begins
            a, b = np.searchsorted(starts, lo), np.searchsorted(starts, hi)
            many = b - a
            at = np.repeat(np.arange(len(q)), many)
            node = starts[np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many) + a[at]]
            q, old, hi = q[at], row[at], hi[at]
            c, size = self.char(node, i - 1), self.length[q]
            step = lambda j: (self.char(q, j) != c).astype(np.int8)
            low = np.minimum(old[:, 1] + 1, old[:, 0] + step(i - 2))
            mid = np.minimum(np.minimum(old[:, 2] + 1, low + 1), old[:, 1] + step(i - 1))
            top = np.minimum(mid + 1, old[:, 2] + step(i))
            row = np.stack([np.where(i - 1 <= size, low, FAR), np.where(i <= size, mid, FAR), np.where(i + 1 <= size, top, FAR)], axis=1).astype(np.int8)
            alive = row.min(axis=1) <= 1
            q, node, row, hi = q[alive], node[alive], row[alive], hi[alive]
            # a word that ends here is the first of its range; its distance is the cell of the whole query
            cell = self.length[q] - i + 1
            ended = np.flatnonzero((self.length[node] == i) & (cell >= 0) & (cell <= 2))
            hit = ended[row[ended, cell[ended]] == 1]
            yield q[hit], node[hit]
            lo, hi = node, np.minimum(hi, np.append(starts, n)[np.searchsorted(starts, node, "right")])


def near_words(words: DataFrame) -> DataFrame:
    """(word, other, n): every ordered pair of words that differ by exactly one inserted, deleted or replaced code point,
    once, with the count of the other. Blocks of many words are shared by tasks."""
    dealt = chunk_pairs(blocks(words), ["_key"], "rest", CHUNK)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["_key", "_pair"]):
            key, rest, pair = table.column("_key").to_pylist(), table.column("rest").to_pylist(), table.column("_pair").to_numpy()
            own, same, count, shorter = (table.column(c).to_numpy() for c in ("_own", "_same", "n", "shorter"))
            new = np.array([True, *(x != y for x, y in zip(key[1:], key[:-1]))]) | np.concatenate([[True], pair[1:] != pair[:-1]])
            block, asks = Block(rest, np.cumsum(new) - 1), np.flatnonzero(shorter)

            def spelt(x: int, y: int) -> str:
                shared = key[x].partition(":")[2]
                return shared + rest[y] if key[x][0] == "p" else rest[y] + shared

            for at in range(0, len(asks), QUERIES):
                found = []
                for q, w in block.near(asks[at:at + QUERIES]):
                    ok = same[q] | (own[q] != own[w])  # rows of one chunk meet in that chunk's own task
                    for x, y in zip(q[ok].tolist(), w[ok].tolist()):
                        if shorter[y]:
                            found.append((spelt(x, x), spelt(x, y), count[y]))
                        elif key[x][0] == "p" or not rest[y].startswith(rest[x]):  # else the prefix has found it
                            found += [(spelt(x, x), spelt(x, y), count[y]), (spelt(x, y), spelt(x, x), count[x])]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), (pa.string(), pa.string(), pa.int64()))], names=["word", "other", "n"])

    return (
        dealt.select("_key", "_pair", "_own", "_same", "rest", "shorter", "n").repartition("_key", "_pair")
        .sortWithinPartitions("_key", "_pair", "rest").mapInArrow(run, "word string, other string, n bigint"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for words with a form. Counts at least double along a chain, so chains are short, and each round
    doubles what a row has followed."""
    at = save(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = at.join(ahead, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved"))
        moved = save(moved)
        if moved.filter("_moved").isEmpty():
            return moved.select("word", "root")
        at = moved.select("word", "root")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of the texts.

    Words are the maximal runs of letters A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased; where 97 divides the crc32 of
    `<id>:<run>`, the run loses the character at crc32 mod its length. Kept are results of 5 characters and 3 occurrences
    at least. Near words differ by exactly one inserted, deleted or replaced code point, whatever their number. The
    form is the near word of the largest n (ties: the smallest in code point order) if that is twice the word's n at
    least; root follows the forms to the last one.

    Null texts have no words; runs in rows with a null id lose nothing; repeated rows count as often as they occur; runs
    may be of any length. No words give no rows.
    """
    words = save(vocabulary(docs, id_col, text_col))
    best = near_words(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n")).alias("less"), F.col("other").alias("form"))).alias("_best"))
    apt = -F.col("_best.less") >= TIMES * F.col("n")
    named = save(words.join(best, "word", "left").select(
        "word", F.when(apt, F.col("_best.form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(apt, -F.col("_best.less")).alias("form_n")))
    return named.join(roots(named.filter("form is not null")), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
