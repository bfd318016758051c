"""Document quality by random Fourier features, ridge regression and isotonic calibration."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contentgate.llm.common import map_texts, save, small_batches

FEATURES = 256
RIDGE = 1e-3
BINS = 1024
THRESHOLD = 0.3
FEW_LABELS = 1 << 20  # ids, 8 MB


def statistics(text: str) -> list[float]:
    """Numbers that describe a text whatever its topic or language; zeros for an empty one."""
    words, n = text.split(), len(text)
    if not words:
        return [0.0] * 18
    chars, k = Counter(text), len(words)
    alpha = upper = digit = space = mark = 0
    for c, m in chars.items():
        if c.isalpha():
            alpha += m
            upper += m if c.isupper() else 0
        elif c.isdigit():
            digit += m
        elif c.isspace():
            space += m
        elif c not in ".,;:'\"()-":
            mark += m
    counts = Counter(words)
    lines = text.split("\n")
    doubled = sum(a == b for a, b in zip(words, words[1:])) / k
    letters = np.fromiter(chars.values(), dtype=float) / n
    return [
        math.log1p(k), (n - space) / k, len(counts) / k ** 0.8, counts.most_common(1)[0][1] / k, doubled,
        len(set(zip(words, words[1:]))) / k, alpha / n, upper / max(1, alpha), digit / n, mark / n, math.log1p(mark),
        math.log1p(len(lines)), math.log1p(n / len(lines)), len(set(lines)) / len(lines), chars["."] / k, chars[","] / k,
        float(-(letters * np.log(letters)).sum()), sum(len(w) <= 3 for w in words) / k,
    ]


def fold(id_col: str) -> Column:
    """crc32 of the id's text modulo 5; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5


@dataclass
class Model:
    """Everything a task needs to score; its size does not depend on the data."""

    mean: np.ndarray
    scale: np.ndarray
    omega: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        x = (stats - self.mean) / self.scale
        waves = np.cos(x @ self.omega + self.phase) * math.sqrt(2 / self.omega.shape[1])
        return np.column_stack([waves, np.clip(x, -5, 5), np.ones(len(x))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(stats), self.knots, self.values) if len(stats) else np.zeros(0)


def isotonic(position: np.ndarray, total: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over bins in order; the mean position and the share of ones of every pool."""
    pools: list[list[float]] = []
    for p, n, y in zip(position, total, ones):
        pools.append([p * n, n, y])
        while len(pools) > 1 and pools[-2][2] / pools[-2][1] >= pools[-1][2] / pools[-1][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    knots, n, y = np.array(pools, dtype=float).T
    return knots / n, (y + 0.5) / (n + 1.0) if len(pools) == 1 else y / n


def with_statistics(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return map_texts(docs.select(F.col(id_col), F.col(text_col)), text_col, [id_col], [("stats", "array<double>")],
                     lambda: lambda texts: [[statistics(t) for t in texts]])


def fit(stats: DataFrame, labels: DataFrame, id_col: str, seed: int = 0) -> Model | None:
    """Fit on all labelled rows outside the held-out fold; None without such rows.

    Each partition adds up its own normal equations and the partial sums are added per row of the matrix, so what
    moves is (features)^2 numbers per partition whatever the number of documents. Folds 2 to 4 fit the ridge scores,
    fold 1 calibrates them through sums over `BINS` ranges of the score. The driver solves one system of fixed size.
    """
    known = labels.filter("quality is not null").select(F.col("doc_id").alias("_label_id"), F.col("quality").cast("double").alias("_y"))
    rows = save(
        stats.join(known, F.col(id_col) == F.col("_label_id")).withColumn("_fold", fold(id_col)).filter("_fold <> 0")
        .select("stats", "_y", "_fold"))
    train = rows.filter("_fold <> 1")
    d = len(statistics(""))
    moments = train.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(F.col("stats")[i]).alias(f"m{i}") for i in range(d)],
        *[F.stddev_pop(F.col("stats")[i]).alias(f"s{i}") for i in range(d)]).first()
    if not moments["n"]:
        return None
    rng = np.random.default_rng(seed)
    scale = np.array([moments[f"s{i}"] for i in range(d)])
    model = Model(
        np.array([moments[f"m{i}"] for i in range(d)]), np.where(scale > 1e-9, scale, 1.0),
        rng.normal(size=(d, FEATURES)) / math.sqrt(2 * d), rng.uniform(0, 2 * math.pi, FEATURES), np.zeros(0), np.zeros(0), np.zeros(0))
    size = FEATURES + d + 1

    def equations(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((size, size + 1)), False
        for batch in batches:
            if batch.num_rows:
                z = model.features(np.array(batch.column(0).to_pylist()))
                total += np.column_stack([z.T @ z, z.T @ batch.column(1).to_numpy()])
                seen = True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "row"])

    def added(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"i": frame["i"].iloc[:1], "row": [np.sum(np.stack(frame["row"].to_list()), axis=0)]})

    parts = train.select("stats", "_y").mapInArrow(equations, "i int, row array<double>")
    summed = parts.groupBy("i").applyInPandas(added, "i int, row array<double>").orderBy("i").collect()  # `size` rows
    system = np.array([r["row"] for r in summed])
    n = moments["n"]
    model.weights = np.linalg.solve(system[:, :-1] + RIDGE * n * np.diag([1.0] * (size - 1) + [1e-9]), system[:, -1])

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                s = np.clip(model.raw(np.array(batch.column(0).to_pylist())), -0.5, 1.5)
                yield pa.RecordBatch.from_arrays([pa.array((s + 0.5) / 2 * BINS).cast(pa.int64(), safe=False), batch.column(1)], names=["bin", "y"])

    for part in (rows.filter("_fold = 1"), train):  # the training rows only where the other fold is empty
        bins = (
            part.select("stats", "_y").mapInArrow(scored, "bin bigint, y double").groupBy("bin")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("ones")).orderBy("bin").collect())  # BINS + 1 rows at most
        if bins:
            break
    at, n, ones = np.array([tuple(b) for b in bins], dtype=float).T
    model.knots, model.values = isotonic((at + 0.5) / BINS * 2 - 0.5, n, ones)
    return model


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, score, predicted for every row of `docs`; only texts enter a score.

    Scores are calibrated shares of label 1. Null and empty texts are scored as texts without words; rows with a null
    id are scored and not held out; repeated rows have equal scores. Without labelled rows every score is 0.5.
    """
    stats = save(with_statistics(docs, id_col, text_col))
    model = fit(stats, labels, id_col)
    kind = docs.schema[id_col].dataType.simpleString()

    def scored(batches):
        for batch in batches:
            x = np.array(batch.column(1).to_pylist(), dtype=float).reshape(batch.num_rows, -1)
            s = model.score(x) if model else np.full(batch.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.float64())], names=[id_col, "score"])

    return stats.mapInArrow(scored, f"`{id_col}` {kind}, score double").select(
        F.col(id_col), F.coalesce(fold(id_col) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that are predicted good, unchanged.

    Statistics for the fit are computed of labelled rows alone, if their ids are few enough (FEW_LABELS) to be sent to every
    task; with more labels, of all rows.
    """
    known = labels.filter("quality is not null").select(F.col("doc_id").alias(id_col)).filter(fold(id_col) != 0).distinct()
    labelled = docs.join(F.broadcast(known), id_col, "left_semi") if known.count() <= FEW_LABELS else docs
    model = fit(with_statistics(labelled, id_col, text_col), labels, id_col)
    if model is None:
        return docs

    def scores(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.array([statistics(t or "") for t in texts], dtype=float).reshape(len(texts), -1)))

    return small_batches(docs).filter(F.pandas_udf(scores, "double")(F.col(text_col).cast("string")) >= THRESHOLD)
