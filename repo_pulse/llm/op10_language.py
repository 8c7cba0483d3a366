"""Operator 10: language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1 (seeded by its code). A letter
3-gram's vector binds its letters' vectors, permuted by position (rolled by
2, 1 and 0), by multiplication; a text's vector bundles (adds) its 3-grams. A
language's prototype bundles all its training texts. A document gets the
language whose prototype has the largest cosine with the document's vector.

Scale: a bundle is counts x vectors, so tasks count 3-grams first and then
multiply matrices in bounded blocks. Training reads every training text in
one scan; a task returns one vector a language and Spark adds them up.
Scoring is a second scan without a shuffle. Prototypes are one vector a
language, stored as a table; they are read and broadcast in groups of at most
``LANGUAGES``, and a document takes its best over all groups. A batch of
documents is bounded by its 3-grams, whatever their lengths.

Rows: NULL text or text without a letter gives ``und`` and score 0; NULL lang
never trains; NULL doc_id is not held out and trains if it has a lang;
without prototypes everything is ``und``; marks (vowel signs, accents) belong
to the word they stand in; equal cosines go to the smaller language; repeated rows score alike; an empty table gives an empty result.
lang, source and doc_id are no inputs of a prediction.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repo_pulse.llm.common import store

DIMENSION = 1024
SEED = 10
FOLDS, HELD = 5, 0
LANGUAGES = 2000  # prototypes in one broadcast
UNKNOWN = "und"
FLUSH = 1 << 21  # 3-grams counted at a time
BLOCK = 2048  # 3-gram vectors multiplied at a time
DOCUMENTS = 256  # documents bundled at a time, if they hold at most
GRAMS = 1 << 18  # different 3-grams

_LETTER: np.ndarray | None = None
_VECTORS: dict[int, np.ndarray] = {}


def letters() -> np.ndarray:
    """Which UTF-16 units belong to words: letters, marks and halves of a pair."""
    global _LETTER
    if _LETTER is None:
        _LETTER = np.array([0xD800 <= c < 0xE000 or chr(c).isalpha() or unicodedata.category(chr(c)) in ("Mn", "Mc") for c in range(1 << 16)])
    return _LETTER


def ngrams(text: str) -> np.ndarray:
    """48-bit codes of the lower-cased text's letter 3-grams; anything between words is one blank."""
    u = np.frombuffer(f" {text.lower()} ".encode("utf-16-le", "surrogatepass"), "<u2")
    word = letters()[u]
    u = np.where(word, u, 32)[word | np.concatenate(([True], word[:-1]))].astype(np.int64)
    return (u[:-2] << 32) | (u[1:-1] << 16) | u[2:] if len(u) > 2 else np.zeros(0, np.int64)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def letter_vectors(units: np.ndarray) -> np.ndarray:
    for c in units.tolist():
        if c not in _VECTORS:
            _VECTORS[c] = np.random.default_rng([SEED, c]).integers(0, 2, DIMENSION, dtype=np.int8) * np.int8(2) - np.int8(1)
    return np.stack([_VECTORS[c] for c in units.tolist()])


def gram_vectors(codes: np.ndarray) -> np.ndarray:
    """One bound vector a 3-gram."""
    parts = [(codes >> 32) & 0xFFFF, (codes >> 16) & 0xFFFF, codes & 0xFFFF]
    out = None
    for roll, part in zip((2, 1, 0), parts):
        units, at = np.unique(part, return_inverse=True)
        v = np.roll(letter_vectors(units), roll, axis=1)[at]
        out = v if out is None else out * v
    return out.astype(np.float32)


def bundle(counted: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Vectors of several texts from their (3-gram codes, counts)."""
    out = np.zeros((len(counted), DIMENSION))
    every, at = np.unique(np.concatenate([c for c, _ in counted]), return_inverse=True)
    order = np.argsort(at, kind="stable")
    at = at[order]
    row = np.repeat(np.arange(len(counted)), [len(c) for c, _ in counted])[order]
    n = np.concatenate([n for _, n in counted])[order]
    for start in range(0, len(every), BLOCK):
        codes = every[start:start + BLOCK]
        a, b = np.searchsorted(at, (start, start + BLOCK))
        counts = np.zeros((len(counted), len(codes)), np.float32)
        counts[row[a:b], at[a:b] - start] = n[a:b]
        out += counts @ gram_vectors(codes)
    return out


def remainder(folds: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds


def _prototypes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    held: dict[str, list[np.ndarray]] = {}
    size = 0

    def flush():
        nonlocal size
        for lang, parts in held.items():
            code, n = np.unique(np.concatenate(parts), return_counts=True)
            sums[lang] = sums.get(lang, 0) + bundle([(code, n)])[0]
        held.clear()
        size = 0

    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
            held.setdefault(lang, []).append(ngrams(text.as_py()))
            size += len(held[lang][-1])
            if size > FLUSH:
                flush()
    flush()
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))], names=["lang", "vector"])


def train(docs: DataFrame, most: int = LANGUAGES) -> list[tuple[list[str], np.ndarray]]:
    """Languages in order and their unit prototypes, from all rows of docs(lang, text); groups of at most ``most``."""
    parts = docs.where("lang IS NOT NULL AND text IS NOT NULL").select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    parts = parts.mapInArrow(_prototypes, "lang string, vector array<double>")
    sums = parts.select("lang", F.posexplode("vector").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
    sums = store(sums, "prototypes")
    out, last = [], None
    while True:  # one group of languages at a time, in order
        left = sums if last is None else sums.where(F.col("lang") > last)
        names = [r["lang"] for r in left.select("lang").distinct().orderBy("lang").limit(most).collect()]
        if not names:
            return out
        last = names[-1]
        rows = left.where(F.col("lang") <= last).toPandas()  # at most ``most`` prototypes
        table = rows.pivot(index="lang", columns="i", values="x").loc[names]
        v = table.to_numpy(dtype=float)
        norm = np.linalg.norm(v, axis=1)
        if (norm > 0).any():
            out.append(([lang for lang, n in zip(names, norm) if n > 0], v[norm > 0] / norm[norm > 0][:, None]))


def identify(docs: DataFrame, languages: list[str], prototypes: np.ndarray) -> Column:
    """Column struct(cosine, lang) of docs' text: the best of these languages; NULL for a text without a letter."""
    shared = docs.sparkSession.sparkContext.broadcast((languages, prototypes))

    @F.pandas_udf("struct<cosine: double, lang: string>")
    def predict(text: pd.Series) -> pd.DataFrame:
        names, protos = shared.value
        lang, best = np.full(len(text), None, object), np.full(len(text), np.nan)
        todo: list[tuple[int, tuple[np.ndarray, np.ndarray]]] = []
        size = 0

        def flush():
            nonlocal size
            v = bundle([c for _, c in todo])
            cosine = (v @ protos.T) / np.maximum(np.linalg.norm(v, axis=1), 1e-12)[:, None]
            first = cosine.argmax(axis=1)
            at = [i for i, _ in todo]
            lang[at] = [names[k] for k in first]
            best[at] = cosine[np.arange(len(first)), first]
            todo.clear()
            size = 0

        for i, t in enumerate(text):
            if has_letter(t):
                todo.append((i, np.unique(ngrams(t), return_counts=True)))
                size += len(todo[-1][1][0])
                if len(todo) == DOCUMENTS or size > GRAMS:
                    flush()
        if todo:
            flush()
        return pd.DataFrame({"cosine": best, "lang": lang})

    return predict(F.col("text").cast("string"))


def language(docs: DataFrame, most: int = LANGUAGES) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every document."""
    held = F.coalesce(remainder(FOLDS) == HELD, F.lit(False))
    groups = train(docs.where(~held), most)
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"),
                      *[identify(docs, names, protos).alias(f"p{k}") for k, (names, protos) in enumerate(groups)])
    lang, cosine = F.lit(None).cast("string"), F.lit(None).cast("double")
    for k in range(len(groups)):  # groups are in order, so a later one must be better
        better = F.col(f"p{k}.lang").isNotNull() & (cosine.isNull() | (F.col(f"p{k}.cosine") > cosine))
        lang, cosine = F.when(better, F.col(f"p{k}.lang")).otherwise(lang), F.when(better, F.col(f"p{k}.cosine")).otherwise(cosine)
    score = F.least(F.greatest(F.coalesce(cosine, F.lit(0.0)), F.lit(0.0)), F.lit(1.0))
    return out.select("doc_id", "held_out", F.coalesce(lang, F.lit(UNKNOWN)).alias("lang_pred"), score.alias("score"))


def op10(docs: DataFrame) -> DataFrame:
    return language(docs)
