"""Linear models over hashed byte n-grams: vectorised features, training in numpy, scoring batch by batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import fold, steps

#: Buckets of the hashed n-grams.
BUCKETS = 4096


def gram_ids(b: np.ndarray, size: int = 3) -> np.ndarray:
    """Bucket of the n-gram that begins at each byte; those that would pass the end are missing."""
    n = max(0, len(b) - size + 1)
    x = np.zeros(n, np.uint32)
    for j in range(size):
        x = (x + b[j : j + n]) * np.uint32(0x9E3779B1)
        x ^= x >> np.uint32(15)
    x *= np.uint32(0x85EBCA6B)
    return (x >> np.uint32(20)).astype(np.int64)


def _inside(o: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First place and number of n-grams of each text."""
    return o[:-1], np.maximum(0, np.diff(o) - size + 1)


def mean_weights(b: np.ndarray, o: np.ndarray, w: np.ndarray, size: int = 3, prior: int = 0) -> np.ndarray:
    """For each text the mean over its n-grams of their rows in w, with so many more of weight 0 (prior), that a few n-grams alone say little; zeros for a text without any."""
    first, count = _inside(o, size)
    out = np.zeros((len(count), w.shape[1]), np.float64)
    g = gram_ids(b, size)
    if not len(g):
        return out
    total = np.zeros((len(count), w.shape[1]))
    some = np.flatnonzero(count)
    edge = np.empty(2 * len(some), np.int64)
    edge[::2], edge[1::2] = first[some], first[some] + count[some]
    for k in range(w.shape[1]):
        v = np.append(w[:, k][g], np.float32(0))
        total[some, k] = np.add.reduceat(v, np.minimum(edge, len(g)), dtype=np.float64)[::2]
    out[some] = total[some] / (count[some, None] + prior)
    return out


def frequencies(b: np.ndarray, o: np.ndarray, size: int = 3, prior: int = 0) -> np.ndarray:
    """Texts by buckets: the share of each text's n-grams in each bucket; prior as in mean_weights()."""
    first, count = _inside(o, size)
    out = np.zeros((len(count), BUCKETS), np.float32)
    g = gram_ids(b, size)
    for i in np.flatnonzero(count):
        out[i] = np.bincount(g[first[i] : first[i] + count[i]], minlength=BUCKETS) / (count[i] + prior)
    return out


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, l2: float = 1e-4, rounds: int = 200, rate: float = 0.05) -> tuple[np.ndarray, np.ndarray]:
    """Weights and intercepts of logistic regressions of the columns of y (0 to 1) on x, by Adam over all rows; of one if y is a vector."""
    one = y.ndim == 1
    x = np.asarray(x, np.float32)
    y = np.asarray(y, np.float32).reshape(len(x), -1)
    weight = np.ones(len(y), np.float32) if weight is None else np.asarray(weight, np.float32)
    weight = (weight / weight.sum())[:, None]
    x = np.concatenate((x, np.ones((len(x), 1), np.float32)), 1)
    w = np.zeros((x.shape[1], y.shape[1]), np.float32)
    m, v, decay = np.zeros_like(w), np.zeros_like(w), np.full((len(w), 1), l2, np.float32)
    decay[-1] = 0
    for t in range(1, rounds + 1):
        g = x.T @ ((sigmoid(x @ w) - y) * weight) + decay * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return (w[:-1, 0], w[-1, 0]) if one else (w[:-1], w[-1])


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _extract(make: Callable, text: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, b, o in steps(batches, text):
            x = np.ascontiguousarray(make(batch, b, o), dtype=np.float16)
            rows = pa.array([r.tobytes() for r in x], pa.binary())
            k = batch.schema.get_field_index(text)
            yield pa.record_batch([*batch.columns[:k], rows], names=[*batch.schema.names[:k], "x"])

    return run


def gather(df: DataFrame, make: Callable, text: str = "text") -> tuple[list, np.ndarray]:
    """The columns before the text and the features (as half floats) of all rows of df, a bounded sample, on the driver, in the order of the first column."""
    k = df.columns.index(text)
    schema = df.select(*df.columns[:k]).withColumn("x", F.lit(b"")).schema
    rows = df.select(*df.columns[: k + 1]).mapInArrow(_extract(make, text), schema).collect()
    rows.sort(key=lambda r: (r[0], r[-1]))
    if not rows:
        return [], np.zeros((0, 1), np.float16)
    return [r[:-1] for r in rows], np.stack([np.frombuffer(r[-1], np.float16) for r in rows]).astype(np.float32)


def folded_frequencies(batch, b: np.ndarray, o: np.ndarray) -> np.ndarray:
    return frequencies(fold(b), o)
