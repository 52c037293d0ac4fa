"""Quality of a text by Naive Bayes support vectors.

Features are indicators of n-grams: one to three consecutive token shapes (case, digits and punctuation with runs
counted once, and whether the token repeats the one before), and single lowered words. They are hashed to FEATURES
numbers. Each indicator is scaled by its class log-count ratio; a linear model with squared hinge loss is fitted to
the scaled indicators by dual coordinate descent, then mixed with the plain Naive Bayes weights. A logistic curve
fitted to margins of rows left out of folds turns margins into probabilities.

The model is fitted on at most FIT_ROWS labelled rows, those with the least hash of their id, and on no more than
FIT_BYTES of their features, so that the driver's share is bounded however long texts are and however often ids repeat;
scoring reads whole texts.

Null or empty text has no features and gets the score of a margin of the intercept alone. Labels that are null are left
out; ids labelled more than once count once for each label row. With no labelled row, or labels of one class only, the
score is the share of label 1 (0.5 with none). Repeated rows give repeated scores. Ties in the order of fitting go by id, label
and features. An empty table gives an empty result. A kept column named score gives way to the result's own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.llm.textkernel import Tokens, Words, chunked, mix, with_text
from tallyweave.session import cut

#: Bound of the labelled rows that a model is fitted on.
FIT_ROWS = 12_000
#: Bound of the fitted rows' features in bytes, four each; a row that would pass it and all after it are left out.
FIT_BYTES = 192 << 20
FEATURES = 1 << 18
ORDER = 3
SMOOTHING, MIXED, COST, EPOCHS, FOLDS = 1.0, 0.25, 0.1, 12, 3
#: Fewest fitted rows that a feature must be in.
LEAST_ROWS = 5


def features(texts: list[str]) -> list[np.ndarray]:
    """Distinct feature numbers of each text, ascending."""
    tokens, words = Tokens(texts), Words(texts)
    shapes = tokens.shapes()
    same = np.zeros(len(shapes), dtype=np.uint64)
    same[1:] = tokens.hashes[1:] == tokens.hashes[:-1]
    shapes = mix(shapes + same * np.uint64(0xA0761D6478BD642F))
    out = []
    for i in range(len(texts)):
        a, b = tokens.firsts[i], tokens.firsts[i + 1]
        own = shapes[a:b].copy()
        if b > a:
            own[0] = mix(np.array([own[0]]) + np.uint64(7))[0]  # a text's first token stands alone, whatever came before
        parts = [mix(words.hashes[words.firsts[i] : words.firsts[i + 1]] + np.uint64(11))]
        for n in range(1, ORDER + 1):
            if len(own) >= n:
                grams = np.zeros(len(own) - n + 1, dtype=np.uint64)
                for k in range(n):
                    grams = grams * np.uint64(0xE7037ED1A0B428DB) + own[k : len(own) - n + 1 + k]
                parts.append(mix(grams + np.uint64(n)))
        out.append(np.unique((np.concatenate(parts) >> np.uint64(46)).astype(np.int32)))
    return out


class Model:
    """Weights of all features, an intercept and the logistic curve over margins."""

    def __init__(self, weights: np.ndarray, intercept: float, slope: float, shift: float):
        self.weights, self.intercept, self.slope, self.shift = weights, intercept, slope, shift

    def margin(self, found: np.ndarray) -> float:
        return float(self.weights[found].sum() / np.sqrt(max(len(found), 1)) + self.intercept)

    def score(self, found: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(found) + self.shift, -30, 30))))


def _descend(rows: list[np.ndarray], values: np.ndarray, y: np.ndarray, cost: np.ndarray, seed: int) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for squared hinge loss; the intercept is one more feature with value 1."""
    w, b = np.zeros(FEATURES), 0.0
    alpha = np.zeros(len(rows))
    scale = [1 / np.sqrt(max(len(r), 1)) for r in rows]
    norm = np.array([(values[r] ** 2).sum() * s * s + 1 for r, s in zip(rows, scale)]) + 0.5 / cost
    rng = np.random.Generator(np.random.PCG64(seed))
    for _ in range(EPOCHS):
        most = 0.0
        for i in rng.permutation(len(rows)):
            r = rows[i]
            x = values[r] * scale[i]
            slope = y[i] * (w[r] @ x + b) - 1 + alpha[i] * 0.5 / cost[i]
            step = max(alpha[i] - slope / norm[i], 0.0) - alpha[i]
            if step:
                alpha[i] += step
                w[r] += step * y[i] * x
                b += step * y[i]
                most = max(most, abs(step))
        if most < 1e-4:
            break
    return w, b


def _weights(rows: list[np.ndarray], label: np.ndarray, seed: int) -> tuple[np.ndarray, float]:
    counts = [np.bincount(np.concatenate([r for r, y in zip(rows, label) if y == k] or [np.zeros(0, np.int32)]), minlength=FEATURES) for k in (0, 1)]
    common = counts[0] + counts[1] >= min(LEAST_ROWS, len(rows))
    p, q = (np.where(common, SMOOTHING + c, 0.0) for c in (counts[1], counts[0]))
    ratio = np.where(common, np.log(np.maximum(p, 1e-9) / p.sum()) - np.log(np.maximum(q, 1e-9) / q.sum()), 0.0) if common.any() else np.zeros(FEATURES)
    share = label.mean()
    cost = np.where(label == 1, COST / (2 * share), COST / (2 * (1 - share)))
    w, b = _descend(rows, ratio, np.where(label == 1, 1.0, -1.0), cost, seed)
    w = ratio * ((1 - MIXED) * np.abs(w[common]).mean() + MIXED * w) if common.any() else w
    return w, b


def fit(rows: list[np.ndarray], label: np.ndarray) -> Model:
    """A model of feature rows and their labels 0 or 1."""
    if len(rows) == 0 or label.min() == label.max():
        share = float(np.clip(label.mean(), 1e-3, 1 - 1e-3)) if len(rows) else 0.5
        return Model(np.zeros(FEATURES), 0.0, 1.0, float(np.log(share / (1 - share))))
    fold = np.arange(len(rows)) % FOLDS
    margins = np.zeros(len(rows))
    for k in range(FOLDS):
        own = np.flatnonzero(fold != k)
        if label[own].min() == label[own].max():
            continue
        w, b = _weights([rows[i] for i in own], label[own], k)
        for i in np.flatnonzero(fold == k):
            margins[i] = w[rows[i]].sum() / np.sqrt(max(len(rows[i]), 1)) + b
    slope, shift = _logistic(margins, label)
    w, b = _weights(rows, label, FOLDS)
    return Model(w, b, slope, shift)


def _logistic(x: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the likeliest logistic curve, by Newton's steps with targets kept off 0 and 1."""
    up, down = (label == 1).sum(), (label == 0).sum()
    target = np.where(label == 1, (up + 1) / (up + 2), 1 / (down + 2))
    beta = np.zeros(2)
    design = np.stack([x, np.ones_like(x)], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, design.T @ (target - p))
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", text: str = "text", fit_rows: int = FIT_ROWS) -> Model:
    """Fit on the labelled rows with the least hash of their id, at most `fit_rows`."""
    chosen = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(F.col(key).alias("__key"), F.col(label).cast("int").alias("__label")).orderBy(F.xxhash64("__key"), "__key", "__label").limit(fit_rows)
    # a bounded number of ids: cheaper to send to the texts than the texts to them
    source = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text")).join(F.broadcast(chosen), "__key").select("__key", "__label", "__text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in chunked(batch.column(2).to_pylist()):
                part = batch.slice(at, len(texts))
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), part.column(1), pa.array([x.astype("<i4").tobytes() for x in features(texts)], pa.binary())], names=["id", "label", "found"])

    found = cut(source.mapInArrow(run, "id long, label int, found binary"))
    order = [F.xxhash64("id"), "id", "label", F.md5("found")]
    # at most fit_rows rows from here on, of which only sizes are added up in order
    first = found.orderBy(*order).limit(fit_rows)
    before = F.sum(F.length("found").cast("long")).over(Window.orderBy(*order))
    rows = first.withColumn("upto", before).where(F.col("upto") <= FIT_BYTES).select("id", "label", "found").collect()
    rows.sort(key=lambda r: (r["id"], r["label"], r["found"]))
    return fit([np.frombuffer(r["found"], dtype="<i4") for r in rows], np.array([r["label"] for r in rows], dtype=np.int64))


def scored(docs: DataFrame, model: Model, keep: list[str], text: str = "text", score: str = "score") -> DataFrame:
    """Columns `keep` and the score under the name `score`. One pass without a shuffle; the broadcast weights have a fixed size."""
    source, schema = with_text(docs, keep, text, {score: "double"})
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in chunked(batch.column(batch.num_columns - 1).to_pylist()):
                part = batch.slice(at, len(texts))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array([shared.value.score(f) for f in features(texts)], pa.float64())], names=[*batch.schema.names[:-1], score])

    return source.mapInArrow(run, schema)
