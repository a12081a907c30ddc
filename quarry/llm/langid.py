"""Language identification by error-correcting output codes.

Every language has a codeword of +1 and -1: all distinct splits of the languages in two for up to six of them
(exhaustive codes), random ones with distinct rows beyond. A logistic classifier over hashed byte trigrams of the folded
text predicts each bit. Decoding takes the language with the least sum of logistic losses, each bit weighted by how far
its classifier is from chance on held-out rows; a document is flagged ambiguous if the second best language is within
MARGIN of the best, the loss being a mean over bits by their weights, or if it has no trigram.

The languages are all those of the labelled documents (rows with a lang). The classifiers are fitted on a bounded sample by
language: of each at most TRAIN_DOCS divided by the number of languages, LEAST_DOCS at least, the first ones in the order of
a hash of their doc_id. Each language weighs the same in the fit, however few documents it has; every fourth document of a
language is held out for the bit weights. Every document's whole text is scored.

Defined results: a text of fewer than three bytes (null and empty ones too) has a null language and is ambiguous; without
labelled rows all languages are null; with one language only, that is the prediction. Ties go to the language that comes
first in the alphabet. Rows that repeat a doc_id are scored one by one; rows without a doc_id are left out.
Other columns, whatever their names, are left as they are, and a text of any length is read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.common import docs_of, fold, steps
from quarry.llm.linear import fit, folded_frequencies, gather, mean_weights
from quarry.session import ship_package

TRAIN_DOCS = 3000
#: Labelled documents of each language in the sample, where there are so many languages that their share of TRAIN_DOCS is less.
LEAST_DOCS = 8
MARGIN = 0.25
#: Shares of trigrams are small numbers; this brings them to a scale at which training is fast.
SCALE = 50.0


def codewords(k: int, seed: int = 5) -> np.ndarray:
    """Languages by bits, of +1 and -1; no two rows are equal, and no column is constant."""
    if k < 2:
        return np.zeros((k, 0))
    if k <= 6:
        bits = np.arange(1, 2 ** (k - 1))
        code = np.array([[1 if i == 0 or not (b >> (i - 1)) & 1 else -1 for b in bits] for i in range(k)])
        return code
    rng = np.random.default_rng(seed)
    best, apart = None, -1
    for _ in range(200):
        code = rng.choice([-1, 1], (k, int(10 * np.ceil(np.log2(k)))))
        code = code[:, np.abs(code.sum(0)) < k]
        d = (((code.shape[1] - code @ code.T) // 2) + np.eye(k, dtype=int) * code.shape[1]).min()
        if d > apart:
            best, apart = code, d
    return best


def decode(f: np.ndarray, code: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Language of each row of bit scores, and how much greater the next best loss is, by unit of weight."""
    loss = (np.log1p(np.exp(-np.clip(f[:, None, :] * code[None], -30, 30))) * weight).sum(2)
    best = loss.argmin(1)
    two = np.sort(loss, 1)[:, :2]
    return best, (two[:, 1] - two[:, 0]) / max(weight.sum(), 1e-9)


def train(x: np.ndarray, y: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code, classifier weights (buckets by bits), intercepts and bit weights, of features and numbers of languages."""
    code = codewords(k)
    x = x * SCALE
    held = np.zeros(len(y), bool)
    for i in range(k):
        held[np.flatnonzero(y == i)[3::4]] = True
    t = code[y] > 0
    w, c = fit(x[~held], t[~held], 1 / np.bincount(y[~held], minlength=k)[y[~held]])
    right = ((x[held] @ w + c > 0) == t[held]).mean(0) if held.any() else np.ones(code.shape[1])
    return code, (w * SCALE).astype(np.float32), c, np.maximum(2 * right - 1, 0.01)


def _predict(langs: list[str], model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, b, o in steps(batches):
            n = len(o) - 1
            some = np.diff(o) >= 3
            if not langs:
                name, margin = pa.nulls(n, pa.string()), np.zeros(n)
            elif len(langs) == 1:
                name, margin = pa.array(np.where(some, langs[0], None), pa.string()), np.where(some, 1.0, 0.0)
            else:
                code, w, c, a = model
                best, margin = decode(mean_weights(fold(b), o, w) + c, code, a)
                margin = np.where(some, margin, 0.0)
                name = pa.array(np.where(some, np.array(langs, object)[best], None), pa.string())
            yield pa.record_batch({"doc_id": batch.column(0), "lang": name, "margin": margin, "ambiguous": pa.array(margin < MARGIN)})

    return run


def identify(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """(doc_id, lang, margin, ambiguous) of every document, predicted from its text by a model of the documents' own lang column."""
    ship_package(docs.sparkSession)
    d = docs_of(docs, "lang")
    known = d.where("lang is not null")
    langs = sorted(r[0] for r in known.select("lang").distinct().collect())
    each = max(LEAST_DOCS, train_docs // max(1, len(langs)))
    w = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = known.select("doc_id", "lang").distinct().withColumn("k", F.row_number().over(w)).where(F.col("k") <= each).select("doc_id", "lang")
    sample = known.join(F.broadcast(ids), ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.min("text").alias("text"))
    rows, x = gather(sample, folded_frequencies) if len(langs) > 1 else ([], None)
    model = train(x, np.array([langs.index(r[1]) for r in rows]), len(langs)) if len(langs) > 1 else None
    return d.select("doc_id", "text").mapInArrow(_predict(langs, model), "doc_id long, lang string, margin double, ambiguous boolean")


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(spark.read.parquet(f"{sf_dir}/documents.parquet"))
