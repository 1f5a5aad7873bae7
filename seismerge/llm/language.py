"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Character n-grams (1 to ``ORDER``) of the lower-cased whole text are hashed to
``BUCKETS`` features; document frequencies come from all training documents.
Weights are fitted on a bounded sample (``PER_CLASS`` documents of each
language) by follow-the-regularised-leader with an elastic-net penalty, so
most weights stay exactly zero; a part of the sample left out of the fit then
sets one temperature for calibrated probabilities.

Defined results: a text that is null, empty or without a letter is ``und``
with score 0. Only rows with an id, a language and a crc32 remainder other
than the held-out one are learned from; without any, every text is ``und``.
Ties go to the language that sorts first. Repeated rows are predicted each;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seismerge.llm.common import held_out, numbered, released, with_columns
from seismerge.llm.fitting import class_counts, fitted, stratified

UNKNOWN = "und"
BUCKETS, ORDER, PER_CLASS = 1 << 16, 3, 1000
ALPHA, BETA, L1, L2, EPOCHS, CALIBRATION = 0.5, 1.0, 0.02, 0.01, 3, 5


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def ngrams(text: str) -> np.ndarray:
    """The bucket of every character n-gram."""
    codes = np.frombuffer(text.lower().encode("utf-32-le"), "<u4")
    grams, run = [], np.zeros(len(codes), np.uint32)
    for n in range(1, ORDER + 1):
        run = run[:len(codes) - n + 1] * np.uint32(0x01000193) + codes[n - 1:] * np.uint32(0x9E3779B1) + np.uint32(n)
        grams.append(((run ^ (run >> np.uint32(15))) * np.uint32(0x85EBCA77)) >> np.uint32(16))
        if len(codes) <= n:
            break
    return np.concatenate(grams)


def document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen, found = np.zeros(BUCKETS, bool), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for text in batch.column(0):
            if text := text.as_py():
                seen[ngrams(text)] = True
                found += seen
                seen[:] = False
    at = np.flatnonzero(found)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(found[at])], names=["bucket", "n"])
    released()


def features(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and their TF-IDF values, scaled to length 1."""
    count = np.bincount(ngrams(text), minlength=BUCKETS)
    at = np.flatnonzero(count)
    x = (1 + np.log(count[at])) * idf[at]
    return at, (x / max(1e-12, np.sqrt(x @ x))).astype(np.float32)


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, classes: int) -> np.ndarray:
    """Weights (buckets + a bias row, classes) after ``EPOCHS`` passes in random order."""
    z, n = np.zeros((BUCKETS + 1, classes)), np.zeros((BUCKETS + 1, classes))

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    rng = np.random.default_rng(5)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            at, x = np.append(rows[i][0], BUCKETS), np.append(rows[i][1], np.float32(1))
            w = weights(z[at], n[at])
            p = softmax(x @ w)
            p[labels[i]] -= 1
            g = x[:, None] * p
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    return weights(z, n)


def temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least cross entropy, by golden section."""
    def loss(t: float) -> float:
        p = softmax(scores / np.exp(t))
        return -np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-300)).mean()
    a, b, ratio = -4.0, 4.0, (5 ** 0.5 - 1) / 2
    for _ in range(40):
        c, d = b - ratio * (b - a), a + ratio * (b - a)
        a, b = (a, d) if loss(c) <= loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def trainer(classes: list[str], idf: np.ndarray):
    def fit(rows: pd.DataFrame) -> dict:
        xs = [features(t, idf) for t in rows["text"]]
        y = np.array([classes.index(c) for c in rows["lang"]])
        aside = np.arange(len(y)) % CALIBRATION == 0
        if len(y) < 2 * CALIBRATION:
            aside[:] = False
        train = np.flatnonzero(~aside)
        w = ftrl([xs[i] for i in train], y[train], len(classes))
        heat = 1.0
        if aside.any():
            scores = np.array([xs[i][1] @ w[xs[i][0]] + w[BUCKETS] for i in np.flatnonzero(aside)])
            heat = temperature(scores, y[aside])
        return {"weights": w.astype(np.float32).tobytes(), "heat": heat}
    return fit


def predictor(classes: list[str], idf: np.ndarray, weights: np.ndarray, heat: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, score = [], []
            for text in batch.column(batch.schema.get_field_index("text")):
                text = text.as_py()
                if not text or not classes or not has_letter(text):
                    lang.append(UNKNOWN)
                    score.append(0.0)
                    continue
                at, x = features(text, idf)
                p = softmax((x @ weights[at] + weights[BUCKETS]).astype(np.float64) / heat)
                best = int(p.argmax())
                lang.append(classes[best])
                score.append(float(p[best]))
            yield with_columns(batch, ["row", "doc_id", "held_out"], lang_pred=pa.array(lang, pa.string()),
                               score=pa.array(score, pa.float64()))
        released()
    return run


def language_id(spark: SparkSession, docs: DataFrame, per_class: int = PER_CLASS, folds: int = 5,
                rest: int = 0) -> DataFrame:
    """row (the input's position), doc_id, held_out, lang_pred, score for every
    document of ``docs(doc_id, text, lang)``; rows with crc32(doc_id) mod ``folds`` = ``rest`` are held out."""
    rows = docs.select(numbered(spark).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang"), held_out(F.col("doc_id"), folds, rest).alias("held_out"))
    known = rows.where("not held_out and lang is not null and text <> ''").select("doc_id", "text", "lang")
    counts = class_counts(known.select("lang"), "lang")
    classes, idf = list(counts), np.zeros(BUCKETS)
    weights, heat = np.zeros((BUCKETS + 1, len(classes)), np.float32), 1.0
    if classes:
        found = (known.select("text").mapInArrow(document_frequencies, "bucket int, n long")
                 .groupBy("bucket").agg(F.sum("n").alias("n")).toPandas())  # BUCKETS rows at most
        n = np.zeros(BUCKETS)
        n[found["bucket"]] = found["n"]
        idf = np.log((1 + sum(counts.values())) / (1 + n)) + 1
        model = fitted(stratified(known, "lang", counts, per_class), trainer(classes, idf), "weights binary, heat double")
        if model:
            weights = np.frombuffer(model["weights"], np.float32).reshape(BUCKETS + 1, -1)
            heat = model["heat"]
    return rows.select("row", "doc_id", "held_out", "text").mapInArrow(
        predictor(classes, idf, weights, heat), "row long, doc_id long, held_out boolean, lang_pred string, score double")
