"""Quality of whole texts by a byte-level convolutional network written in numpy.

A text's UTF-8 bytes are cut into overlapping chunks that cover it whole.  Learned filters of a few
bytes slide over every chunk; the largest answer of each filter in a chunk is kept (max-pooling).
The document's probability combines, over all its chunks, the mean and the largest pooled answers.
Filters are trained on single chunks by Adam, the combination afterwards on whole documents.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import remainder, text_or_empty

#: Bytes between chunk starts; a chunk is two strides long, so neighbours overlap by half.
STRIDE = 256
#: Strides whose convolution is held at once; bounds memory for texts of any length.
STRIDES_AT_ONCE = 2048


@dataclass(frozen=True)
class QualityModel:
    """``filters``: (width, 256, count) tables, one row a byte; ``bias``: (count,)."""

    filters: np.ndarray
    bias: np.ndarray
    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    intercept: float


def convolve(data: np.ndarray, filters: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Rectified answers at every position of ``data`` where a whole filter fits."""
    width = len(filters)
    count = len(data) - width + 1
    total = filters[0][data[:count]]
    for j in range(1, width):
        total += filters[j][data[j : j + count]]
    total += bias
    return np.maximum(total, 0, out=total)


def pooled(text: bytes, filters: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """(chunks, filters): largest answers in each chunk; a text shorter than a filter is padded by zero bytes."""
    width = len(filters)
    data = np.frombuffer(text.ljust(width, b"\0"), np.uint8)
    parts = []
    for start in range(0, max(len(data) - width + 1, 1), STRIDE * STRIDES_AT_ONCE):
        answers = convolve(data[start : start + STRIDE * STRIDES_AT_ONCE + width - 1], filters, bias)
        parts.append(np.maximum.reduceat(answers, np.arange(0, len(answers), STRIDE), axis=0))
    strides = np.concatenate(parts)
    return np.maximum(strides[:-1], strides[1:]) if len(strides) > 1 else strides


def summary(text: bytes, filters: np.ndarray, bias: np.ndarray) -> np.ndarray:
    chunks = pooled(text, filters, bias)
    return np.concatenate([chunks.mean(0), chunks.max(0), chunks.min(0), [np.log1p(len(text))]])


def probability(text: str | None, model: QualityModel) -> float:
    features = summary((text or "").encode("utf-8", "replace"), model.filters, model.bias)
    logit = float(((features - model.center) / model.scale) @ model.weights + model.intercept)
    return float(1 / (1 + np.exp(-np.clip(logit, -30, 30))))


def logistic(features: np.ndarray, labels: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Newton's method for ridge logistic regression; the last weight is the intercept and is not shrunk."""
    x = np.column_stack([features, np.ones(len(features))])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    weights = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (labels - p) - penalty * weights
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        weights += step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def train(
    texts: Sequence[str | None], labels: Sequence[int], width: int = 5, count: int = 16, epochs: int = 6, seed: int = 7
) -> QualityModel:
    """Learns filters on chunks that carry their document's label, then the combination on whole documents.

    With no rows, or one label only, the probability is the share of label 1 (0.5 without rows).
    """
    raw = [(t or "").encode("utf-8", "replace") for t in texts]
    truth = np.asarray(labels, np.float64)
    rng = np.random.default_rng(seed)
    filters = rng.normal(0, 0.3, (width, 256, count)).astype(np.float32)
    bias = np.zeros(count, np.float32)
    size = 3 * count + 1
    if not len(truth) or truth.min() == truth.max():
        share = (truth.sum() + 0.5) / (len(truth) + 1)
        return QualityModel(
            filters, bias, np.zeros(size), np.ones(size), np.zeros(size), float(np.log(share / (1 - share)))
        )
    length = 2 * STRIDE
    # A few chunks of every training document, spread over it; scoring reads all chunks.
    chunks, owner = [], []
    for i, data in enumerate(raw):
        starts = range(0, max(len(data) - STRIDE, 1), STRIDE)
        for k in np.unique(np.linspace(0, len(starts) - 1, 4).astype(int)):
            chunks.append(np.frombuffer(data[starts[k] : starts[k] + length].ljust(length, b"\0"), np.uint8))
            owner.append(i)
    chunks, target = np.stack(chunks), truth[owner]
    balance = np.where(target > 0, 0.5 / target.mean(), 0.5 / (1 - target.mean()))
    top = np.zeros(count + 1)
    top[:count] = rng.normal(0, 0.3, count)
    state = {k: [np.zeros_like(v, np.float64), np.zeros_like(v, np.float64)] for k, v in (("f", filters), ("b", bias), ("t", top))}
    step = 0

    def adam(name: str, value: np.ndarray, slope: np.ndarray, rate: float) -> None:
        first, second = state[name]
        first *= 0.9
        first += 0.1 * slope
        second *= 0.999
        second += 0.001 * slope**2
        value -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)

    positions = length - width + 1
    for _ in range(epochs):
        order = rng.permutation(len(chunks))
        for at in range(0, len(order), 64):
            pick = order[at : at + 64]
            step += 1
            data = chunks[pick]
            answers = filters[0][data[:, :positions]]
            for j in range(1, width):
                answers = answers + filters[j][data[:, j : j + positions]]
            best = answers.argmax(1)
            value = np.take_along_axis(answers, best[:, None], 1)[:, 0] + bias
            alive = np.maximum(value, 0)
            p = 1 / (1 + np.exp(-np.clip(alive @ top[:count] + top[count], -30, 30)))
            error = balance[pick] * (p - target[pick]) / len(pick)
            slope = error[:, None] * top[:count] * (value > 0)
            by_filter = np.zeros(filters.shape)
            for j in range(width):
                np.add.at(by_filter[j], (np.take_along_axis(data, best + j, 1), np.arange(count)[None]), slope)
            adam("t", top, np.append(error @ alive, error.sum()), 0.02)
            adam("b", bias, slope.sum(0), 0.01)
            adam("f", filters, by_filter, 0.02)
    features = np.stack([summary(data, filters, bias) for data in raw])
    center, scale = features.mean(0), features.std(0) + 1e-6
    weights = logistic((features - center) / scale, truth)
    return QualityModel(filters, bias, center, scale, weights[:-1], float(weights[-1]))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, limit: int) -> list:
    """At most ``limit`` labelled (text, label) rows whose remainder is not 2, the same ones at every run.

    Rows are ordered by a hash of the id, so the sample is spread over the labelled rows.
    """
    learn = labels.select("doc_id", F.col(label).cast("int").alias("label"))
    learn = learn.where(F.col("label").isin(0, 1) & (remainder("doc_id", 4) != 2)).distinct()
    learn = learn.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(limit)
    picked = docs.select("doc_id", text_or_empty()).join(F.broadcast(learn), "doc_id")
    picked = picked.groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    return picked.orderBy(F.xxhash64("doc_id"), "doc_id", "label").select("text", "label").collect()


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = 3000) -> QualityModel:
    """Trains on a documented, bounded sample of ``sample`` labelled rows."""
    rows = training_rows(docs, labels, label, sample)
    return train([r["text"] for r in rows], [r["label"] for r in rows])


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id, held_out, score of every row of ``docs`` (doc_id, text, ...); other columns are ignored.

    NULL or empty text is scored as no bytes.  A NULL doc_id is scored too; its held_out is NULL.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scores(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["score"] = np.array([probability(t, shared.value) for t in batch["text"]], np.float64)
            yield batch[["doc_id", "held_out", "score"]]

    held = (remainder("doc_id", 4) == 2).alias("held_out")
    return docs.select(F.col("doc_id").cast("long"), held, text_or_empty()).mapInPandas(
        scores, "doc_id long, held_out boolean, score double"
    )
