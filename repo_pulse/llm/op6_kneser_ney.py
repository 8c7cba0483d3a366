"""Operator 6: quality classifier by interpolated modified Kneser-Ney perplexity.

A character n-gram model (order 4, over UTF-16 units, one model a language) is
trained on trusted text: documents whose label says quality 1. All of them
calibrate: crc32(doc_id) deals them into ``FOLDS``, and each is scored by a
model whose counts leave out its fold. The language's threshold is a quantile
of these log-perplexities. A
document whose log-perplexity is above its language's threshold is rejected;
one whose language has no model or threshold is kept.

Counting: tasks turn text into 64-bit n-gram codes and pre-aggregate them;
the counts of each order, context totals, discounts and probabilities are
grouped sums and joins on (language, code), hash-sharded by Spark. Lower
orders use continuation counts. All trusted text is counted.

Scoring: the most frequent probabilities, at most ``LOCAL_ROWS`` rows (a
proven bound), go to every task. If the whole model fits, a missing n-gram
backs off in the task and documents move nowhere. Beyond that, n-grams the
task does not know leave as pre-aggregated (document, n-gram, times) rows and
join the sharded model, order by order. Both ways give the same sums.

Rows: NULL or empty text has no perplexity (NULL) and is kept; NULL language
has no model; repeated rows score alike; an empty table or no trusted rows
gives kept = true throughout; a document with conflicting labels is trusted
only if all say 1; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repo_pulse.llm.common import fresh, row_key, store

ORDER = 4
LOCAL_ROWS = 1_000_000
QUANTILE = 0.99
MARGIN = 0.0  # added to the quantile of the log-perplexity
FOLDS = 10  # each fold of the trusted documents is scored by a model of the others
BIN = 1000  # quantiles are read from a histogram of 1/1000 nat
FLUSH = 1 << 19  # n-grams a task holds before it counts them
TABLE = 1 << 21  # distinct n-grams a task holds before it passes them on
TRUSTED = 1_000_000  # trusted ids up to this number are broadcast (8 MB); more are joined by a shuffle
START, END = 0xFFFF, 0xFFFE  # no characters


def codes(text: str) -> np.ndarray:
    """The text's n-grams of full order, one a unit and one for the end, 16 bits a unit."""
    units = np.frombuffer(text.encode("utf-16-le", "surrogatepass"), "<u2").astype(np.uint64)
    units = np.concatenate((np.full(ORDER - 1, START, np.uint64), units, np.array([END], np.uint64)))
    n = len(units) - ORDER + 1
    out = np.zeros(n, np.uint64)
    for i in range(ORDER):
        out = (out << np.uint64(16)) | units[i:i + n]
    return out.view(np.int64)


def mask(order: int) -> int:
    """Keeps the last ``order`` units of a code."""
    return (1 << (16 * order)) - 1 if order < ORDER else -1


def _merge(code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes with their summed counts."""
    at = np.argsort(code, kind="stable")
    code, n = code[at], n[at]
    first = np.nonzero(np.concatenate(([True], code[1:] != code[:-1])))[0] if len(code) else np.zeros(0, np.int64)
    return code[first], np.add.reduceat(n, first) if len(first) else n


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of each task: raw n-grams up to FLUSH are merged into at most TABLE distinct ones a language."""
    held: dict[str, list[np.ndarray]] = {}
    size = 0
    tables: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def merge():
        nonlocal size
        for lang, parts in held.items():
            code, n = np.unique(np.concatenate(parts), return_counts=True)
            if lang in tables:
                code, n = np.concatenate((tables[lang][0], code)), np.concatenate((tables[lang][1], n))
            tables[lang] = _merge(code, n)
        held.clear()
        size = 0

    def out(lang):
        code, n = tables.pop(lang)
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(code), pa.string()), pa.array(code), pa.array(n, pa.int64())], names=["lang", "code", "n"])

    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
            found = codes(text.as_py())
            held.setdefault(lang, []).append(found)
            size += len(found)
            if size > FLUSH:
                merge()
                if sum(len(c) for c, _ in tables.values()) > TABLE:
                    for each in list(tables):
                        yield out(each)
    merge()
    for lang in list(tables):
        yield out(lang)


def _discounts(grams: DataFrame) -> DataFrame:
    """Per language: d1, d2, d3 from the counts of counts; clipped to their count where those are too few."""
    n = [F.count_if(F.col("a") == i).cast("double").alias(f"n{i}") for i in (1, 2, 3, 4)]
    c = grams.groupBy("lang").agg(*n)
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))

    def d(i: int) -> Column:
        have, more = F.col(f"n{i}"), F.col(f"n{i + 1}")
        return F.when((F.col("n1") > 0) & (have > 0), F.greatest(F.lit(0.1), F.least(F.lit(i * 1.0), i - (i + 1) * y * F.try_divide(more, have)))).otherwise(i / 2)

    return c.select("lang", *[d(i).alias(f"d{i}") for i in (1, 2, 3)])


def _discount() -> Column:
    return F.when(F.col("a") == 1, F.col("d1")).when(F.col("a") == 2, F.col("d2")).otherwise(F.col("d3"))


def counted(texts: DataFrame) -> DataFrame:
    """texts(lang, text) -> full-order counts (lang, code, a), stored."""
    texts = texts.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).where("lang IS NOT NULL AND text != ''")
    return store(texts.mapInArrow(_count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("a")), "grams")


def train(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """texts(lang, text) -> the model of their counts."""
    return model(counted(texts))


def model(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored counts(lang, code, a) -> probabilities (lang, k, code, a, logp) and back-off weights (lang, k, code, bow), stored.

    ``code`` of the back-off rows is the context; k its length. The row of the
    unknown unit has k = 0 and code 0.
    """
    grams = {ORDER: counts}
    for k in range(ORDER - 1, 0, -1):  # continuation counts
        grams[k] = store(grams[k + 1].groupBy("lang", F.col("code").bitwiseAND(F.lit(mask(k)).cast("long")).alias("code")).agg(F.count("*").alias("a")), "grams")
    lower, backs, probs = None, [], []
    for k in range(1, ORDER + 1):
        g = grams[k].join(store(_discounts(grams[k]), "discounts"), "lang")  # stored: its size is known, so n-grams stay where they are
        g = g.withColumn("context", F.shiftrightunsigned("code", 16)).withColumn("d", _discount())
        total = g.groupBy("lang", "context").agg(F.sum("a").alias("total"), F.sum("d").alias("left"), F.count("*").alias("kinds"))
        # what discounting takes away is the weight of the lower order
        total = store(total.withColumn("weight", F.col("left") / F.col("total")), "contexts")
        g = g.join(total.select("lang", "context", "total", "weight", "kinds"), ["lang", "context"])
        if k == 1:
            uniform = 1.0 / (F.col("kinds") + 1)
            p = g.withColumn("p", (F.col("a") - F.col("d")) / F.col("total") + F.col("weight") * uniform)
            probs.append(total.select("lang", F.lit(0).alias("k"), F.lit(0).cast("long").alias("code"), F.col("total").alias("a"), F.log(F.col("weight") * uniform).alias("logp")))
        else:
            p = g.withColumn("suffix", F.col("code").bitwiseAND(F.lit(mask(k - 1)).cast("long")))
            p = p.join(lower.select("lang", F.col("code").alias("suffix"), F.col("p").alias("q")), ["lang", "suffix"])
            p = p.withColumn("p", (F.col("a") - F.col("d")) / F.col("total") + F.col("weight") * F.col("q"))
            backs.append(total.select("lang", F.lit(k - 1).alias("k"), F.col("context").alias("code"), F.log("weight").alias("bow")))
        lower = store(p.select("lang", "code", "a", "p"), "order")
        probs.append(lower.select("lang", F.lit(k).alias("k"), "code", "a", F.log("p").alias("logp")))

    def union(tables):
        out = tables[0]
        for t in tables[1:]:
            out = out.unionByName(t)
        return out

    return store(union(probs), "probs"), store(union(backs), "backs")


class Local:
    """The part of a model that every task holds: sorted codes by language and order."""

    def __init__(self, probs: pa.Table, backs: pa.Table, complete: bool):
        self.complete = complete
        self.p, self.b = self._index(probs, "logp"), self._index(backs, "bow")

    @staticmethod
    def _index(t: pa.Table, value: str) -> dict[tuple[str, int], tuple[np.ndarray, np.ndarray]]:
        found = {}
        f = pd.DataFrame({"lang": t["lang"].to_pandas(), "k": t["k"].to_numpy(), "code": t["code"].to_numpy(), "v": t[value].to_numpy()})
        for key, part in f.groupby(["lang", "k"]):
            at = np.argsort(part["code"].to_numpy())
            found[key[0], int(key[1])] = part["code"].to_numpy()[at], part["v"].to_numpy()[at]
        return found

    @staticmethod
    def _look(table, key) -> tuple[np.ndarray, np.ndarray]:
        code, value = table
        at = np.minimum(np.searchsorted(code, key), len(code) - 1)
        return code[at] == key, value[at]

    def score(self, lang: str, text: str) -> tuple[float, int, np.ndarray]:
        """Sum of log-probabilities, number of units, and the codes left for the sharded model."""
        code = codes(text)
        n, total, none = len(code), 0.0, np.zeros(0, np.int64)
        if (lang, 0) not in self.p:
            return math.nan, n, none
        for k in range(ORDER, 0, -1):
            if (lang, k) in self.p:
                hit, value = self._look(self.p[lang, k], code)
                total += float(value[hit].sum())
                code = code[~hit]
            if not self.complete:
                return total, n, code
            if not len(code):
                return total, n, none
            if k > 1:
                hit, value = self._look(self.b[lang, k - 1], (code.view(np.uint64) >> np.uint64(16)).view(np.int64))
                total += float(value[hit].sum())
                code = code & mask(k - 1)
        return total + len(code) * float(self.p[lang, 0][1][0]), n, none


def local(probs: DataFrame, backs: DataFrame, limit: int = LOCAL_ROWS) -> Local:
    """The whole model if it has at most ``limit`` rows, else its most frequent full-order rows."""
    if probs.count() + backs.count() <= limit:
        return Local(probs.toArrow(), backs.toArrow(), True)
    head = probs.where((F.col("k") == ORDER) | (F.col("k") == 0)).orderBy(F.col("k"), F.col("a").desc(), "lang", "code").limit(limit)
    return Local(head.toArrow(), backs.limit(0).toArrow(), False)


def resolve(grams: DataFrame, probs: DataFrame, backs: DataFrame) -> DataFrame:
    """grams(lang, code) -> (lang, code, logp) by joins with the sharded model, from the full order down."""
    left = grams.withColumn("now", F.col("code")).withColumn("sum", F.lit(0.0))
    done = None
    for k in range(ORDER, -1, -1):
        p = probs.where(F.col("k") == k).select("lang", F.col("code").alias("now"), "logp")
        j = left.withColumn("now", F.lit(0).cast("long")).join(p, ["lang", "now"]) if k == 0 else left.join(p, ["lang", "now"], "left")
        j = store(j, "resolve")
        hit = j.where("logp IS NOT NULL").select("lang", "code", (F.col("sum") + F.col("logp")).alias("logp"))
        done = hit if done is None else done.unionByName(hit)
        if k > 1:
            b = backs.where(F.col("k") == k - 1).select("lang", F.col("code").alias("context"), "bow")
            left = j.where("logp IS NULL").drop("logp").withColumn("context", F.shiftrightunsigned("now", 16)).join(b, ["lang", "context"], "left")
            left = left.select("lang", "code", F.col("now").bitwiseAND(F.lit(mask(k - 1)).cast("long")).alias("now"), (F.col("sum") + F.coalesce("bow", F.lit(0.0))).alias("sum"))
        else:
            left = j.where("logp IS NULL").drop("logp")
    return done


def with_log_perplexity(docs: DataFrame, probs: DataFrame, backs: DataFrame, name: str, limit: int = LOCAL_ROWS) -> DataFrame:
    """docs with the column ``name``: mean negative log-probability a unit, NULL without text or model."""
    known = local(probs, backs, limit)
    shared = docs.sparkSession.sparkContext.broadcast(known)
    text, lang = F.col("text").cast("string"), F.col("lang").cast("string")
    if known.complete:
        @F.arrow_udf("double")
        def mean(text: pa.Array, lang: pa.Array) -> pa.Array:
            out = []
            for t, l in zip(text, lang.to_pylist()):
                t = t.as_py()
                total, n, _ = shared.value.score(l, t) if t and l else (math.nan, 1, None)
                out.append(None if math.isnan(total) else -total / n)
            return pa.array(out, pa.float64())

        return docs.withColumn(name, mean(text, lang))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "key", "lang", "units", "total", "code", "times"]
        for b in batches:
            for i, key, l, t in zip(*(c.to_pylist() for c in b.columns)):
                total, n, rest = shared.value.score(l, t) if t and l else (math.nan, 1, np.zeros(0, np.int64))
                if math.isnan(total):
                    continue
                code, times = np.unique(rest, return_counts=True)
                m = len(code) + 1
                yield pa.RecordBatch.from_arrays([pa.array([i] * m, pa.int64()), pa.array([key] * m, pa.int64()), pa.array([l] * m, pa.string()), pa.array([n] * m, pa.int64()),
                                                  pa.array([total] + [None] * (m - 1), pa.float64()), pa.array([None, *code.tolist()], pa.int64()), pa.array([None, *times.tolist()], pa.int64())], names=names)

    narrow = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("id"), row_key(docs).alias("key"), lang.alias("lang"), text.alias("text"))
    rows = store(narrow.mapInArrow(scan, "id long, key long, lang string, units long, total double, code long, times long").distinct(), "scores")
    tail = rows.where("code IS NOT NULL")
    answers = store(resolve(tail.select("lang", "code").distinct(), probs, backs), "answers")
    tail = tail.join(answers, ["lang", "code"]).groupBy("id", "key").agg(F.sum(F.col("logp") * F.col("times")).alias("more"))
    score = rows.where("code IS NULL").join(tail, ["id", "key"], "left")
    i, k = fresh(docs, "_id"), fresh(docs, "_key")
    score = store(score.select(F.col("id").alias(i), F.col("key").alias(k), (-(F.col("total") + F.coalesce("more", F.lit(0.0))) / F.col("units")).alias(name)), "perplexity")
    d = docs.withColumn(i, F.coalesce(F.col("doc_id").cast("long"), F.lit(-1))).withColumn(k, row_key(docs))
    return d.join(score, [i, k], "left").drop(i, k)


def thresholds(scored: DataFrame, name: str, quantile: float = QUANTILE, margin: float = MARGIN) -> DataFrame:
    """(lang, threshold): the exact quantile of a fine histogram, one bounded row set a language."""
    h = scored.where(F.col(name).isNotNull()).groupBy("lang", F.floor(F.col(name) * BIN).alias("bin")).agg(F.count("*").alias("n"))
    up = F.sum("n").over(Window.partitionBy("lang").orderBy("bin"))
    h = h.withColumn("up", up).withColumn("all", F.sum("n").over(Window.partitionBy("lang")))
    return h.where(F.col("up") >= F.col("all") * quantile).groupBy("lang").agg(((F.min("bin") + 1) / BIN + margin).alias("threshold"))


def trusted_ids(labels: DataFrame) -> DataFrame:
    return labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("q"), F.max("quality").alias("m")).where("q = 1 AND m = 1").select("doc_id")


def _of_fold(lang: Column | str, fold: Column) -> Column:
    return F.concat(lang, F.lit("\x01"), fold.cast("string"))


def cross_fit(texts: DataFrame, limit: int = LOCAL_ROWS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """texts(doc_id, lang, text) -> (lang, lp) of each by the counts of the other folds, and the model of all counts."""
    fold = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS).cast("int")
    texts = store(texts.where("lang IS NOT NULL AND text != ''").withColumn("fold", fold), "trusted_texts")
    part = counted(texts.select(_of_fold("lang", F.col("fold")).alias("lang"), "text"))
    part = part.select(F.expr("left(lang, length(lang) - 2)").alias("lang"), F.expr("cast(right(lang, 1) AS int)").alias("fold"), "code", "a")
    both = part.groupBy("lang", "code").agg(F.sum("a").alias("a"), F.array(*[F.sum(F.when(F.col("fold") == i, F.col("a")).otherwise(0)) for i in range(FOLDS)]).alias("own"))
    both = store(both, "grams")
    probs, backs = model(both.drop("own"))
    rest = both.select("lang", "code", "a", F.posexplode("own").alias("fold", "n")).where("a > n")
    fold_probs, fold_backs = model(store(rest.select(_of_fold("lang", F.col("fold")).alias("lang"), "code", (F.col("a") - F.col("n")).alias("a")), "grams"))
    held = texts.select("doc_id", "text", "fold", F.col("lang").alias("plain"), _of_fold("lang", F.col("fold")).alias("lang"))
    if fold_probs.count() + fold_backs.count() <= limit:
        scored = store(with_log_perplexity(held, fold_probs, fold_backs, "lp", limit).select(F.col("plain").alias("lang"), "lp"), "held_scores")
    else:  # one fold's model at a time
        scored = None
        for i in range(FOLDS):
            ours = F.col("lang").endswith(f"\x01{i}")
            each = store(with_log_perplexity(held.where(F.col("fold") == i), fold_probs.where(ours), fold_backs.where(ours), "lp", limit).select(F.col("plain").alias("lang"), "lp"), "held_scores")
            scored = each if scored is None else scored.unionByName(each)
    return scored, probs, backs


def classify(docs: DataFrame, trusted: DataFrame, quantile: float = QUANTILE, margin: float = MARGIN, limit: int = LOCAL_ROWS,
             score: str = "log_perplexity", threshold: str = "threshold", kept: str = "kept") -> DataFrame:
    """docs with three more columns: log-perplexity, the language's threshold, and whether to keep the row.

    trusted(doc_id) names the trusted documents.
    """
    trusted = store(trusted, "trusted")
    if trusted.count() <= TRUSTED:
        trusted = F.broadcast(trusted)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    held, probs, backs = cross_fit(base.join(trusted, "doc_id", "left_semi"), limit)
    limits = store(thresholds(held, "lp", quantile, margin), "thresholds")
    lang = fresh(docs, "_lang")
    out = with_log_perplexity(docs, probs, backs, score, limit)
    out = out.join(limits.select(F.col("lang").alias(lang), F.col("threshold").alias(threshold)), out["lang"].cast("string") == F.col(lang), "left").drop(lang)
    return out.withColumn(kept, F.coalesce(F.col(score) <= F.col(threshold), F.lit(True)))


def op6(docs: DataFrame, labels: DataFrame) -> DataFrame:
    narrow = docs.select("doc_id", "lang", "source", "text")
    out = classify(narrow, trusted_ids(labels))
    return out.select("doc_id", "lang", F.exp("log_perplexity").alias("perplexity"), F.exp("threshold").alias("threshold"), "kept")
