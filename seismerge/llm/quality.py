"""Quality classifier: support vectors over n-grams scaled by class log-count ratios.

Tokens are runs of letters (case kept), digits or other signs; the features
are hashed token 1- and 2-grams, present or not; a token followed by itself is
one 2-gram whatever the token, and thrice in a row one 3-gram, so that
repetition is learned across vocabularies. Each feature is scaled by the
log ratio of its smoothed counts in the two classes, taken over all labelled
training documents. A linear hinge-loss model over the scaled indicators is
then fitted by dual coordinate descent on a bounded sample (``PER_CLASS``
documents of each class), and a logistic curve on the part left out of the fit
turns margins into probabilities at the classes' true shares.

Defined results: a null or empty text has no features and gets the score of a
zero margin plus bias. Labels other than 0 and 1, labels without a document and
rows without an id are not learned from; a repeated label counts each time.
With one class only, its probability is certain; with none, scores are 0.5.
Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seismerge.llm.common import byte_sums, held_out, mix, prepared, slices, span_hash, with_columns, written
from seismerge.llm.fitting import class_counts, fitted, stratified

BITS, PER_CLASS, CUT = 17, 3000, 0.3
SMOOTH, COST, EPOCHS, CALIBRATION = 1.0, 1.0, 20, 5
SIZE = 1 << BITS

_TWICE, _THRICE = 1, 2

_KIND = np.full(256, 3, np.uint8)  # signs
_KIND[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0
_KIND[48:58] = 2
_KIND[65:91] = _KIND[97:123] = _KIND[128:] = 1


def features(data: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
    """Per row the distinct buckets of its token n-grams."""
    if not len(data):
        return [np.zeros(0, np.int64)] * (len(off) - 1)
    kind = _KIND[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    edge[1:-1] |= kind[1:] != kind[:-1]
    cuts = np.flatnonzero(edge)
    start, end = cuts[:-1], cuts[1:]
    some = kind[start] > 0
    start, end = start[some], end[some]
    token = span_hash(byte_sums(data), start, end)
    first = np.searchsorted(start, off)
    one = (token >> np.uint64(64 - BITS)).astype(np.int64)
    two = (mix(token[:-1] * np.uint64(3) + token[1:]) >> np.uint64(64 - BITS)).astype(np.int64)
    same = np.flatnonzero(token[:-1] == token[1:])
    two[same] = _TWICE
    two[same[np.flatnonzero(np.diff(same) == 1)]] = _THRICE
    seen, out = np.zeros(SIZE, bool), []
    for a, b in zip(first[:-1], first[1:]):
        seen[one[a:b]] = True
        seen[two[a:max(a, b - 1)]] = True
        at = np.flatnonzero(seen)
        seen[at] = False
        out.append(at)
    return out


def class_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found = np.zeros((2, SIZE), np.int64)
    for rows, data, off in slices(batches):
        for label, at in zip(rows.column(rows.schema.get_field_index("quality")).to_pylist(), features(data, off)):
            found[label, at] += 1
    at = np.flatnonzero(found.any(0))
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(found[0, at]), pa.array(found[1, at])],
                                     names=["bucket", "low", "high"])


def descend(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Hinge-loss weights (and a bias at the end) by dual coordinate descent."""
    w, alpha, rng = np.zeros(SIZE + 1), np.zeros(len(rows)), np.random.default_rng(5)
    xs = [scaled(at, ratio) for at in rows]
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            at, x = np.append(rows[i], SIZE), np.append(xs[i], 1.0)
            slope = y[i] * (x @ w[at]) - 1
            new = min(max(alpha[i] - slope / (x @ x), 0.0), COST * weight[i])
            if new != alpha[i]:
                w[at] += (new - alpha[i]) * y[i] * x
                alpha[i] = new
    return w


def scaled(at: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    """Indicators times log-count ratios, by the root of the number of features."""
    return ratio[at] / np.sqrt(max(1, len(at)))


def logistic(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the curve with the least weighted cross entropy (Newton steps)."""
    target = np.where(y > 0, 1 - 1e-3, 1e-3)
    ab, x = np.array([1.0, 0.0]), np.stack([margin, np.ones(len(margin))], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ ab, -30, 30)))
        grad = x.T @ (weight * (p - target)) + 1e-3 * ab
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        ab = ab - step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return max(1e-6, float(ab[0])), float(ab[1])


def trainer(ratio: np.ndarray):
    def fit(rows: pd.DataFrame) -> dict:
        raw = [t.encode() for t in rows["text"]]
        xs = []
        for a in range(0, len(raw), 256):
            part = raw[a:a + 256]
            xs += features(np.frombuffer(b"".join(part), np.uint8), np.cumsum([0] + [len(p) for p in part]))
        label = rows["quality"].to_numpy()
        y, weight = np.where(label == 1, 1.0, -1.0), 1 / rows["rate"].to_numpy()
        aside = np.zeros(len(y), bool)
        for c in (-1, 1):  # every class on both sides
            own = np.flatnonzero(y == c)
            aside[own[::CALIBRATION]] = len(own) >= 2 * CALIBRATION
        share = {c: (~aside & (y == c)).sum() for c in (-1, 1)}
        even = np.array([(~aside).sum() / (2 * max(1, share[c])) for c in y])
        w = descend([xs[i] for i in np.flatnonzero(~aside)], y[~aside], ratio, even[~aside])
        aside = aside if (y[aside] > 0).any() and (y[aside] < 0).any() else np.ones(len(y), bool)
        margin = np.array([scaled(xs[i], ratio) @ w[xs[i]] + w[SIZE] for i in np.flatnonzero(aside)])
        slope, shift = logistic(margin, y[aside], weight[aside] / weight[aside].mean())
        return {"weights": (w * slope).astype(np.float32).tobytes(), "shift": shift}
    return fit


def scorer(ratio: np.ndarray, weights: np.ndarray, shift: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_bucket = ratio * weights[:SIZE]
        for rows, data, off in slices(batches):
            margin = np.array([by_bucket[at].sum() / np.sqrt(max(1, len(at))) for at in features(data, off)])
            score = 1 / (1 + np.exp(-np.clip(margin + weights[SIZE] + shift, -30, 30)))
            yield with_columns(rows, ["doc_id", "held_out"], score=pa.array(score, pa.float64()))
    return run


def quality_scores(spark: SparkSession, docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS,
                   cut: float = CUT, folds: int = 5, rest: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted for every document of ``docs(doc_id,
    text)``, learned from ``labels(doc_id, quality)``."""
    prepared(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       held_out(F.col("doc_id"), folds, rest).alias("held_out"))
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    # A shuffle at every size: labels grow with the documents and are not broadcast.
    known = written(spark, rows.where("not held_out").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
                    .join(marks.where("quality in (0, 1)").hint("merge"), "doc_id"), "labelled")
    counts = class_counts(known, "quality")
    ratio, weights, shift = np.zeros(SIZE), np.zeros(SIZE + 1, np.float32), 0.0
    if len(counts) == 1:
        shift = 30.0 if 1 in counts else -30.0
    elif counts:
        found = (known.mapInArrow(class_features, "bucket int, low long, high long")
                 .groupBy("bucket").agg(F.sum("low").alias("low"), F.sum("high").alias("high")).toPandas())  # SIZE rows at most
        low, high = np.full(SIZE, SMOOTH), np.full(SIZE, SMOOTH)
        low[found["bucket"]] += found["low"]
        high[found["bucket"]] += found["high"]
        ratio = np.log(high / high.sum()) - np.log(low / low.sum())
        model = fitted(stratified(known, "quality", counts, per_class), trainer(ratio), "weights binary, shift double")
        if model:
            weights, shift = np.frombuffer(model["weights"], np.float32), model["shift"]
    return rows.select("doc_id", "held_out", "text").mapInArrow(
        scorer(ratio, weights, shift), "doc_id long, held_out boolean, score double").select(
        "*", (F.col("score") >= cut).cast("int").alias("predicted"))
