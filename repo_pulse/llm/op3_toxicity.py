"""Operator 3: toxicity by a character n-gram linear classifier with naive Bayes features.

Features are the hashed character 4- and 5-grams present in a text (lower
case, white space as one blank). Each is scaled by its naive Bayes log-count
ratio, log((p + a) / P) - log((q + a) / Q), with p and q the toxic and clean
training documents that hold it; a logistic regression is fitted on the
scaled features. Presence is not divided by length, so a few toxic words
count in a very long text too.

Training reads a bounded sample: the ``SAMPLE`` labelled documents of each
class with the smallest hash of doc_id, whole texts; weights restore the true
share of the classes. A doc_id that repeats weighs as one document: its rows
are merged by text, each text with its share. Should the distinct texts exceed
the bound, every doc_id's first text (by hash) goes before further ones. The
model is ``SELECTED`` weights. Its fit on the driver handles at most 2 x SAMPLE
sparse rows over these features, which a count checks first.
Scoring is one scan of all whole texts without a shuffle.

Rows: NULL or empty text scores as a text without features (the intercept);
NULL doc_id is not held out and never trains; labels that contradict each
other for one doc_id count as toxic; NULL labels are ignored; without labels
of both classes every score is 0; repeated rows score alike; an empty table
gives an empty result. lang, source and other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repo_pulse.llm.common import store

SIZES = (4, 5)
BITS = 20
SAMPLE = 3000  # labelled documents of each class
SELECTED = 6000  # features kept
ALPHA = 1.0
L2 = 1e-3
STEPS = 300
RATE = 0.05
THRESHOLD = 0.3
FOLDS, HELD = 4, 2

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0x100000001B3)


def ngrams(text: str) -> np.ndarray:
    """Hash values (BITS wide) of the text's n-grams, with repeats."""
    u = np.frombuffer(f" {text} ".lower().encode("utf-16-le", "surrogatepass"), "<u2")
    blank = u <= 32
    u = np.where(blank, 32, u)[~(blank & np.concatenate(([False], blank[:-1])))].astype(np.uint64)
    out = []
    for n in SIZES:
        if len(u) >= n:
            h = np.full(len(u) - n + 1, n, np.uint64)
            for i in range(n):
                h = h * _BASE + u[i:i + len(h)]
            out.append(((h ^ (h >> np.uint64(29))) * _ODD) >> np.uint64(64 - BITS))
    return np.concatenate(out).astype(np.int64) if out else np.zeros(0, np.int64)


def remainder(folds: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds


def training_ids(labels: DataFrame, sample: int = SAMPLE) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, y) of the bounded sample, and how many labelled training documents each class has."""
    y = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(remainder(FOLDS) != HELD)
    y = y.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("y"))
    y = store(y, "labels")
    total = {r["y"]: r["n"] for r in y.groupBy("y").agg(F.count("*").alias("n")).collect()}
    h = F.xxhash64("doc_id", F.lit(3))
    picked = y.where("y = 1").orderBy(h, "doc_id").limit(sample).unionByName(y.where("y = 0").orderBy(h, "doc_id").limit(sample))
    return store(picked, "sample"), total


def _present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for y, weight, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
            found = np.unique(ngrams(text.as_py() or "")).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array([y], pa.int32()), pa.array([weight], pa.float64()), pa.array([found], pa.list_(pa.int32()))], names=["y", "weight", "grams"])


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((2, 1 << BITS))
    for b in batches:
        for y, weight, grams in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
            counts[y][grams.values.to_numpy()] += weight
    gram = np.nonzero(counts.sum(axis=0))[0]
    yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(counts[0][gram]), pa.array(counts[1][gram])], names=["gram", "clean", "toxic"])


def fit_logistic(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, y: np.ndarray, weight: np.ndarray, width: int) -> tuple[np.ndarray, float]:
    """Weighted L2 logistic regression on sparse entries (row, col, value), full gradients with adaptive steps."""
    w, b = np.zeros(width), 0.0
    m, v = np.zeros(width + 1), np.zeros(width + 1)
    weight = weight / weight.sum()
    b = float(np.log((weight * y).sum() / (weight * (1 - y)).sum()))
    for t in range(1, STEPS + 1):
        z = b + np.bincount(rows, values * w[cols], len(y))
        g = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        grad = np.append(np.bincount(cols, values * g[rows], width) + L2 * w, g.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        step = RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w, b


class Model:
    """Per hashed n-gram: the weight times the log-count ratio, 0 where not selected."""

    def __init__(self, weights: np.ndarray | None, intercept: float):
        self.weights, self.intercept = weights, intercept
        self.used = None if weights is None else weights != 0

    def score(self, text: str | None) -> float:
        if self.weights is None:
            return 0.0
        h = ngrams(text or "")
        z = self.intercept + float(self.weights[np.unique(h[self.used[h]])].sum())
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def training_rows(docs: DataFrame, ids: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(y, weight, text), at most 2 x sample rows: one a distinct text of a sampled doc_id, weights of a doc_id add up to 1."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # at most 2 x sample ids are broadcast; repeats are merged before they move
    once = store(texts.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "y", F.xxhash64("text").alias("h")).agg(F.count("*").alias("times"), F.first("text").alias("text")), "toxic_texts")
    firsts = once.groupBy("doc_id").agg(F.min("h").alias("least"))
    if once.count() > 2 * sample:
        ranked = once.join(firsts, "doc_id").withColumn("further", F.col("h") != F.col("least"))
        pick = lambda y: ranked.where(F.col("y") == y).select("doc_id", "h", "further").orderBy("further", F.xxhash64("doc_id", "h"), "doc_id", "h").limit(sample)
        once = store(once.join(F.broadcast(pick(0).unionByName(pick(1)).select("doc_id", "h")), ["doc_id", "h"]), "toxic_texts")
    all_times = once.groupBy("doc_id").agg(F.sum("times").alias("all"))
    return once.join(F.broadcast(all_times), "doc_id").select("y", (F.col("times") / F.col("all")).alias("weight"), "text")


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, selected: int = SELECTED) -> Model:
    ids, total = training_ids(labels, sample)
    rows = store(training_rows(docs, ids, sample).mapInArrow(_present, "y int, weight double, grams array<int>"), "toxic_rows")
    n = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.sum("weight").alias("n")).collect()}
    if not n.get(0) or not n.get(1):
        return Model(None, 0.0)
    counts = rows.mapInArrow(_document_counts, "gram long, clean double, toxic double").groupBy("gram").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    p, q = (F.col("toxic") + ALPHA) / (n[1] + 2 * ALPHA), (F.col("clean") + ALPHA) / (n[0] + 2 * ALPHA)
    counts = counts.withColumn("ratio", F.log(p) - F.log(q)).withColumn("gain", F.abs(F.col("ratio")) * F.abs(p - q))
    best = counts.where("clean + toxic >= 3 - 1e-9").orderBy(F.col("gain").desc(), "gram").limit(selected).select("gram", "ratio").toPandas()
    if not len(best):
        return Model(None, 0.0)
    at = np.full(1 << BITS, -1, np.int32)
    at[best["gram"].to_numpy()] = np.arange(len(best))
    shared = docs.sparkSession.sparkContext.broadcast(at)

    def only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [shared.value[g.values.to_numpy()] for g in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([f[f >= 0] for f in found], pa.list_(pa.int32()))], names=["y", "weight", "at"])

    data = rows.mapInArrow(only, "y int, weight double, at array<int>").toArrow()  # at most 2 x sample rows of selected features
    y = data["y"].to_numpy().astype(float)
    lists = data["at"].combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    cols = lists.flatten().to_numpy()
    ratio = best["ratio"].to_numpy()
    share = {c: total[c] / n[c] for c in (0, 1)}
    w, b = fit_logistic(np.repeat(np.arange(len(y)), sizes), cols, ratio[cols], y, data["weight"].to_numpy() * np.where(y == 1, share[1], share[0]), len(best))
    weights = np.zeros(1 << BITS, np.float32)
    weights[best["gram"].to_numpy()] = w * ratio
    return Model(weights, b)


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, selected: int = SELECTED, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, sample, selected))

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        return pa.array([shared.value.score(t.as_py()) for t in text], pa.float64())

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(remainder(FOLDS) == HELD, F.lit(False)).alias("held_out"), score(F.col("text").cast("string")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op3(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return toxicity(docs, labels)
