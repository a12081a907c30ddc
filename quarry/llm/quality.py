"""Quality classification by co-training of a text view and a metadata view.

The text view sees what is written: shares of hashed byte trigrams of the unfolded text, the share of words that are the
same as the word before, and words by distinct word. The metadata view sees only what
can be told without reading: source and lang (hashed), length, number of lines, mean and longest line, and the shares of
blank, upper-case and non-letter bytes. Both are logistic.

They start from at most TRAIN_DOCS labelled documents (the first in the order of a hash of their doc_id; a quarter of these is
held out). In each of ROUNDS rounds both score every unlabelled document of the table, and the PSEUDO documents of
either class of which one view is most certain, at CONFIDENT or more, join the other view's training set, unless the other
view is as certain of the opposite. The scores of the two views are then calibrated and combined by one logistic
regression on the held-out documents (Platt scaling in two variables), and every document is scored by whole text.

Defined results: labels that contradict each other for a doc_id count as low quality; labels without a document or a
value are left out; if there are no labels of both classes, every document has the score 1 and is kept. A null or empty
text has the features of an empty one, and is scored by them. Rows without a doc_id are scored like all others; rows that repeat
one are scored one by one. Ties in certainty go to the lesser doc_id. An empty table gives no rows.
Other columns, whatever their names, are left as they are, and a text of any length is read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import numbered, steps, words
from quarry.llm.linear import fit, frequencies, gather, mean_weights, sigmoid
from quarry.session import cut, drop_cut, ship_package

TRAIN_DOCS = 4000
ROUNDS = 2
PSEUDO = 100
CONFIDENT = 0.95
KEEP = 0.5
SCALE = 50.0
#: Trigrams of no weight that are added to each text, so that a few words alone say little.
PRIOR = 60
_SLOTS = 16
_META = 8 + 2 * _SLOTS


def _slot(values: pa.Array) -> np.ndarray:
    """Hashed slot of each string; nulls have the last one."""
    d = values.dictionary_encode()
    if isinstance(d, pa.ChunkedArray):
        d = d.combine_chunks()
    names = np.array([xxhash.xxh32_intdigest(v or "") % (_SLOTS - 1) for v in d.dictionary.to_pylist()] + [_SLOTS - 1])
    return names[d.indices.fill_null(len(names) - 1).to_numpy(zero_copy_only=False)]


def metadata(batch: pa.RecordBatch, b: np.ndarray, o: np.ndarray) -> np.ndarray:
    """Features of the metadata view: texts by _META."""
    n = len(o) - 1
    x = np.zeros((n, _META), np.float32)
    size = np.diff(o)
    some = np.flatnonzero(size)

    def per_text(mask: np.ndarray) -> np.ndarray:
        c = np.concatenate(([0], np.cumsum(mask)))
        return c[o[1:]] - c[o[:-1]]

    newline = b == 10
    lines = per_text(newline) + 1
    at = np.flatnonzero(newline)
    cuts = np.unique(np.concatenate((at + 1, o)))
    length = np.diff(cuts) if len(cuts) > 1 else np.zeros(0, np.int64)
    longest = np.zeros(n, np.int64)
    if len(length):
        np.maximum.at(longest, np.minimum(np.searchsorted(o, cuts[:-1], "right") - 1, n - 1), length)
    upper = (b >= 65) & (b <= 90)
    letter = upper | ((b >= 97) & (b <= 122)) | (b >= 128)
    safe = np.maximum(size, 1)
    x[:, 0] = np.log1p(size) / 10
    x[:, 1] = np.log1p(lines) / 5
    x[:, 2] = np.log1p(size / lines) / 8
    x[:, 3] = np.log1p(longest) / 10
    x[some, 4] = (per_text(b == 32) / safe)[some]
    x[some, 5] = (per_text(upper) / safe)[some]
    x[some, 6] = (per_text(~letter & (b != 32) & ~newline) / safe)[some]
    x[:, 7] = size == 0
    rows = np.arange(n)
    for k, name in enumerate(("source", "lang")):
        x[rows, 8 + k * _SLOTS + _slot(batch.column(batch.schema.get_field_index(name)))] = 0.5
    return x


def repetition(b: np.ndarray, o: np.ndarray) -> np.ndarray:
    """Of each text the share of words that repeat the one before, and the logarithm of words by distinct word; zeros without words."""
    h, _, _, ptr = words(b, o)
    n = np.diff(ptr)
    doc = np.repeat(np.arange(len(n)), n)
    again = np.flatnonzero((h[1:] == h[:-1]) & (doc[1:] == doc[:-1]))
    order = np.lexsort((h, doc))
    new = np.ones(len(h), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (doc[1:] != doc[:-1])
    distinct = np.bincount(doc[new], minlength=len(n))
    some = n > 0
    out = np.zeros((len(n), 2), np.float32)
    out[some, 0] = 10 * (np.bincount(doc[again], minlength=len(n)) / (n + 5))[some]
    out[some, 1] = (np.log(np.maximum(n, 1)) - np.log(np.maximum(distinct, 1)))[some]
    return out


def _both(batch, b, o):
    return np.concatenate((frequencies(b, o, prior=PRIOR) * SCALE, repetition(b, o), metadata(batch, b, o)), 1)


def _score(text_w, text_c, meta_w, meta_c):
    w = (text_w[:-2] * SCALE).astype(np.float32)[:, None]

    def run(batch, b, o):
        return mean_weights(b, o, w, prior=PRIOR)[:, 0] + repetition(b, o) @ text_w[-2:] + text_c, metadata(batch, b, o) @ meta_w + meta_c

    return run


def _scores(score):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, b, o in steps(batches):
            t, m = score(batch, b, o)
            yield pa.record_batch({"doc_id": batch.column(0), "t": np.asarray(t, np.float64), "m": np.asarray(m, np.float64)})

    return run


def _final(score, blend):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, b, o in steps(batches, "__q_text"):
            t, m = score(batch, b, o)
            p = sigmoid(blend[0] * t + blend[1] * m + blend[2])
            k = batch.schema.get_field_index("source")
            yield pa.record_batch([*batch.columns[:k], pa.array(np.asarray(p, np.float64))], names=[*batch.schema.names[:k], "__q_p"])

    return run


def _view(docs: DataFrame) -> DataFrame:
    """doc_id, source, lang and text as the models read them; columns that are missing are null."""
    d, at = numbered(docs)
    pick = [F.col(at[c]).cast("string").alias(c) if c in at else F.lit(None).cast("string").alias(c) for c in ("source", "lang", "text")]
    return d.select(F.col(at["doc_id"]).try_cast("long").alias("doc_id"), *pick)


def choose(scores: DataFrame, sure: float, pseudo: int, taken: set[int]) -> dict[str, dict[int, float]]:
    """For each view the documents that the other is most certain of, with their pseudo-labels: of scores (doc_id, t, m) at most so many of either class; those in taken are left out."""
    extra: dict[str, dict[int, float]] = {"t": {}, "m": {}}
    for mine, other in (("t", "m"), ("m", "t")):
        for good in (1.0, -1.0):
            best = scores.where((F.col(mine) * good >= sure) & (F.col(other) * good > -sure)).groupBy("doc_id").agg(F.max(F.col(mine) * good).alias("s"))
            new = [r["doc_id"] for r in best.orderBy(F.desc("s"), "doc_id").limit(pseudo + len(taken)).collect() if r["doc_id"] not in taken]
            for d in new[:pseudo]:
                extra[other].setdefault(d, float(good > 0))
    return extra


def train(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS, rounds: int = ROUNDS, pseudo: int = PSEUDO):
    """The scoring function of both views and how to blend them; None if there is nothing to learn from."""
    d = _view(docs)
    t, names = numbered(labels)
    lab = t.select(F.col(names["doc_id"]).try_cast("long").alias("doc_id"), F.col(names["quality"]).cast("int").alias("q")).where("doc_id is not null and q is not null").groupBy("doc_id").agg(F.min("q").alias("q"))
    known = lab.join(d.where("doc_id is not null").select("doc_id"), "doc_id", "left_semi")
    ids = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_docs)
    rows, x = gather(d.join(F.broadcast(ids), "doc_id").select("doc_id", "q", "source", "lang", "text"), _both)
    y = np.array([r[1] > 0 for r in rows], float)
    if len(rows) < 4 or y.min() == y.max():
        return None
    held = np.arange(len(rows)) % 4 == 3
    if y[held].min() == y[held].max() or y[~held].min() == y[~held].max():
        held = np.zeros(len(rows), bool)
    cols = {"t": slice(0, x.shape[1] - _META), "m": slice(x.shape[1] - _META, None)}
    sets = {v: (x[~held][:, cols[v]], y[~held]) for v in cols}
    z = x[held] if held.any() else x
    del x
    models = {v: fit(*sets[v], l2=1e-5, rounds=400) for v in cols}
    taken: set[int] = set()
    sure = float(np.log(CONFIDENT / (1 - CONFIDENT)))
    for _ in range(rounds):
        # all documents are scored, and labelled ones left out after that: three numbers a document are shuffled, and no text
        s = d.where("doc_id is not null").mapInArrow(_scores(_score(*models["t"], *models["m"])), "doc_id long, t double, m double")
        s = cut(s.join(lab, "doc_id", "left_anti"), "scores")
        extra = choose(s, sure, pseudo, taken)
        drop_cut(s)
        want = {k: v for e in extra.values() for k, v in e.items()}
        if not want:
            break
        chosen = d.sparkSession.createDataFrame([(int(k),) for k in want], "doc_id long")
        got, xs = gather(d.join(F.broadcast(chosen), "doc_id", "left_semi").select("doc_id", "source", "lang", "text"), _both)
        for v in cols:
            use = [i for i, r in enumerate(got) if r[0] in extra[v]]
            if use:
                sets[v] = (np.concatenate((sets[v][0], xs[use][:, cols[v]])), np.concatenate((sets[v][1], [extra[v][got[i][0]] for i in use])))
                models[v] = fit(*sets[v], l2=1e-5, rounds=400)
        taken |= set(want)
    both = np.stack([z[:, cols[v]] @ models[v][0] + models[v][1] for v in ("t", "m")], 1)
    w, c = fit(both, y[held] if held.any() else y, l2=1e-3, rounds=500)
    return _score(*models["t"], *models["m"]), (float(max(w[0], 0)), float(max(w[1], 0)), float(c))


def _with_score(docs: DataFrame, labels: DataFrame, keep: list[str], **how) -> DataFrame:
    """The kept columns of docs, named as numbered() does, and __q_p, the probability that a document is of good quality."""
    ship_package(docs.sparkSession)
    d, at = numbered(docs)
    kept = [at[c] for c in keep] if keep else d.columns
    model = train(docs, labels, **how)
    if model is None:
        return d.select(*kept, F.lit(1.0).alias("__q_p"))
    pick = [(F.col(at[c]) if c in at else F.lit(None)).cast("string").alias(n) for c, n in (("source", "source"), ("lang", "lang"), ("text", "__q_text"))]
    return d.select(*kept, *pick).mapInArrow(_final(*model), d.select(*kept).withColumn("__q_p", F.lit(0.5)).schema)


def score(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """(doc_id, p_quality, keep) of every document."""
    s = _with_score(docs, labels, ["doc_id"], **how)
    return s.select(F.col(s.columns[0]).alias("doc_id"), F.col("__q_p").alias("p_quality"), (F.col("__q_p") >= KEEP).alias("keep"))


def keep_good(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """The documents whose score is KEEP or more, with all their columns."""
    return _with_score(docs, labels, [], **how).where(F.col("__q_p") >= KEEP).drop("__q_p").toDF(*docs.columns)


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
