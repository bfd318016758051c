"""Language ID: multinomial naive Bayes over hashed character n-grams.

Texts become lower-case letters with single spaces in place of everything else; their 1- to 4-grams, within one text, are
hashed into a fixed number of buckets. Tasks add up one count per (language, bucket); the log probabilities of
the buckets are a matrix of bounded size that is broadcast, and a batch is scored by adding up matrix rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contentgate.llm.common import small_batches

ORDERS = 4
BITS = 15  # buckets of the hash, as a power of two, while the matrix stays within CELLS
CELLS = 1 << 24
SMOOTHING = 0.1
TILE = 1 << 20
STEP, SPREAD = np.uint32(0x01000193), np.uint32(0x9E3779B1)
SPACE = 32


def fold(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string")) % 4


@cache
def letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts end to end and the place where each starts. A text is a zero, a space, its lower-case letters with one
    space for every stretch of other characters, and a space."""
    flat = np.frombuffer("".join("\0 " + t.lower().replace("\0", " ") + " " for t in texts).encode("utf-32-le", "surrogatepass"), "<u4")
    codes = np.where(letters()[flat] | (flat == 0), flat, np.uint32(SPACE))
    blank = codes == SPACE
    codes = codes[~(blank & np.concatenate([[False], blank[:-1]]))]
    return codes, np.flatnonzero(codes == 0)


def buckets(codes: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order, the bucket of the n-gram at every position and whether there is one: it stays inside its text
    and is no lone space."""
    inside = codes != 0
    value, valid = np.zeros(len(codes), dtype=np.uint32), np.ones(len(codes), dtype=bool)
    for n in range(1, ORDERS + 1):
        ahead, there = np.zeros_like(codes), np.zeros(len(codes), dtype=bool)
        ahead[: len(codes) - n + 1], there[: len(codes) - n + 1] = codes[n - 1:], inside[n - 1:]
        value = value * STEP + ahead
        valid = valid & there
        yield ((value + np.uint32(n)) * SPREAD >> np.uint32(32 - bits)).astype(np.int64), valid & (codes != SPACE) if n == 1 else valid


def counts(texts: list[str], classes: np.ndarray, n_classes: int, bits: int) -> np.ndarray:
    """Count per (class, bucket) of the texts' n-grams."""
    codes, starts = code_points(texts)
    of = np.repeat(classes, np.diff(starts, append=len(codes)))
    total = np.zeros(n_classes << bits, dtype=np.int64)
    for bucket, valid in buckets(codes, bits):
        total += np.bincount(((of << bits) + bucket)[valid], minlength=len(total))
    return total.reshape(n_classes, -1)


def sums(texts: list[str], weights: np.ndarray) -> np.ndarray:
    """For each text the sum of its n-grams' rows of `weights` (buckets + 1 rows, the last one zero)."""
    codes, starts = code_points(texts)
    bits = (len(weights) - 1).bit_length() - 1
    out = np.zeros((len(texts), weights.shape[1]))
    step = max(1, TILE // weights.shape[1])
    for bucket, valid in buckets(codes, bits):
        bucket = np.where(valid, bucket, len(weights) - 1)
        for at in range(0, len(codes), step):
            end = min(at + step, len(codes))
            first, last = np.searchsorted(starts, at, "right") - 1, np.searchsorted(starts, end, "left")
            out[first:last] += np.add.reduceat(weights[bucket[at:end]], np.maximum(starts[first:last], at) - at, axis=0)
    return out


class Model:
    """Languages in code point order, log priors, and log probabilities as a matrix of buckets + 1 by languages."""

    def __init__(self, langs: list[str], rows: np.ndarray, table: np.ndarray):
        self.langs = langs
        self.prior = np.log(rows / rows.sum())
        smooth = table + SMOOTHING
        logs = np.log(smooth / smooth.sum(axis=1, keepdims=True)).T
        self.weights = np.vstack([logs, np.zeros((1, len(langs)))])


def predict(texts: list[str], langs: list[str], prior: np.ndarray, weights: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Language and its posterior probability; `und` and 0 for texts without a letter, or if nothing was learned."""
    if not langs or not texts:
        return ["und"] * len(texts), np.zeros(len(texts))
    joint = sums(texts, weights) + prior
    best = joint.argmax(axis=1)
    score = 1 / np.exp(joint - joint.max(axis=1, keepdims=True)).sum(axis=1)
    lettered = np.array([any(map(str.isalpha, t)) for t in texts])
    return [langs[b] if ok else "und" for b, ok in zip(best, lettered)], np.where(lettered, score, 0.0)


def fit(train: DataFrame, text_col: str, lang_col: str) -> Model | None:
    """Fit on every row of `train` with a language; None without such rows.

    The number of buckets is 2^15, halved while languages x buckets would pass 2^24 cells (128 MB); beyond 2^14 languages
    it raises. What is collected and broadcast is that matrix. A task passes on its own sums, one row per cell at most.
    """
    train = train.filter(F.col(lang_col).isNotNull()).select(F.col(text_col).cast("string").alias("_t"), F.col(lang_col).cast("string").alias("_l"))
    rows = sorted((r["_l"], r["n"]) for r in train.groupBy("_l").agg(F.count(F.lit(1)).alias("n")).limit((CELLS >> 10) + 1).collect())
    if not rows:
        return None
    langs, bits = [r[0] for r in rows], BITS
    while len(langs) << bits > CELLS and bits > 10:
        bits -= 1
    if len(langs) << bits > CELLS:
        raise ValueError("more languages than the matrix may hold")
    index = {lang: k for k, lang in enumerate(langs)}

    def added(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(langs), 1 << bits), dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                of = np.array([index[x] for x in batch.column(1).to_pylist()])
                total += counts([t or "" for t in batch.column(0).to_pylist()], of, len(langs), bits)
        cell = np.flatnonzero(total)
        for at in range(0, len(cell), 1 << 16):
            part = cell[at:at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total.ravel()[part])], names=["cell", "n"])

    found = small_batches(train).mapInArrow(added, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(len(langs) << bits)
    table[found["cell"].to_numpy()] = found["n"].to_numpy()
    return Model(langs, np.array([r[1] for r in rows], dtype=float), table.reshape(len(langs), -1))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """id, held_out, lang_pred, score for every row of `docs`.

    Learned from rows with a language whose crc32(id as text) mod 4 is not 2, whole texts, all of them; held_out marks the
    others. A row with a null id has no fold: it is not learned from and not held out. Only texts enter a prediction.
    `lang_pred` is a learned language (ties: the first in code point order), or `und` with score 0 where the text is null
    or has no letter, and everywhere if there is nothing to learn from. `score` is the posterior of the prediction.
    Languages may be any string, the empty one included; repeated rows count as often as they occur.
    """
    model = fit(docs.filter(fold(id_col) != 2), text_col, lang_col)
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast((model.langs, model.prior, model.weights) if model else ([], None, None))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, score = predict([t or "" for t in batch.column(0).to_pylist()], *shared.value)
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=[id_col, "lang_pred", "score"])

    found = small_batches(docs).select(F.col(text_col).cast("string").alias("_t"), F.col(id_col)).mapInArrow(
        run, f"`{id_col}` {kind}, lang_pred string, score double")
    return found.select(F.col(id_col), F.coalesce(fold(id_col) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")
