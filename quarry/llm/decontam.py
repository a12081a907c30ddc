"""Benchmark decontamination with an FM-index over each shard of the training documents.

The phrases searched are the runs of PHRASE words of each benchmark text; a text of MIN_ITEM words or more, but fewer than
PHRASE, is one phrase itself, and shorter ones are not searched. Symbols are the benchmark's words; every other word and
every end of a document is a separator, each a symbol of its own that sorts before all words, so suffixes are in a total
order by the first separator at the latest.

For each shard of about SHARD_WORDS words of whole documents: prefix doubling gives the suffix array, its Burrows-Wheeler
transform goes into a wavelet matrix with rank directories, all phrases are searched backwards side by side, and each
occurrence walks back to the next sampled suffix position (every SAMPLE-th place and each place after a separator).
Occurrences that overlap or touch are merged into the spans to remove. No text leaves its task, and there is no shuffle
as long as the benchmark has at most SLICE_WORDS words; a larger one is searched slice by slice on the uncut text, and the slices'
spans are merged.

Defined results: rows without a doc_id are not reported, but remove_leaks() cuts them too; rows that repeat a doc_id give
their spans once each; null and empty texts have no spans; an empty benchmark or table gives no rows. Where several items
have a phrase, the span carries the least item_id (null if none has an id). Other columns, whatever their names, are left as they are.
A text of any length is searched whole, within one shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import docs_of, numbered, sorted_runs, steps, text_words, words
from quarry.llm.substring import cut_text
from quarry.session import cut, drop_cut, ship_package

PHRASE = 8
MIN_ITEM = 5
SHARD_WORDS = 1 << 20
SAMPLE = 32
SLICE_WORDS = 2_000_000
_NO_ITEM = np.iinfo(np.int64).max


class Bits:
    """A bit vector with ranks: 64-bit words and the count before each."""

    def __init__(self, bits: np.ndarray) -> None:
        packed = np.packbits(bits, bitorder="little")
        w = np.zeros(len(bits) // 64 + 1, np.uint64)
        w.view(np.uint8)[: len(packed)] = packed
        self.w = w
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(w), dtype=np.int64)[:-1]))

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before place i."""
        k = i >> 6
        below = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[k] + np.bitwise_count(self.w[k] & below)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.w[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)


class WaveletMatrix:
    """Ranks of symbols below 2**depth."""

    def __init__(self, x: np.ndarray, depth: int) -> None:
        self.depth, self.levels, self.zeros = depth, [], []
        for level in range(depth - 1, -1, -1):
            bit = (x >> level) & 1 == 1
            self.levels.append(Bits(bit))
            self.zeros.append(len(x) - int(bit.sum()))
            x = np.concatenate((x[~bit], x[bit]))

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol c before the place i that goes with it."""
        s = np.zeros_like(i)
        for k, (bits, z) in enumerate(zip(self.levels, self.zeros, strict=True)):
            one = ((c >> (self.depth - 1 - k)) & 1).astype(bool)
            ri, rs = bits.rank(i), bits.rank(s)
            i = np.where(one, z + ri, i - ri)
            s = np.where(one, z + rs, s - rs)
        return i - s

    def symbol(self, i: np.ndarray) -> np.ndarray:
        """The symbols at places i."""
        c = np.zeros_like(i)
        for bits, z in zip(self.levels, self.zeros, strict=True):
            one = bits.get(i).astype(bool)
            r = bits.rank(i)
            i = np.where(one, z + r, i - r)
            c = (c << 1) | one
        return c


def suffix_order(x: np.ndarray, depth: int) -> np.ndarray:
    """Places of x in the order of their suffixes; every 0 is a symbol of its own, in the order of places, below all others."""
    n = len(x)
    zero = x == 0
    z, p = np.flatnonzero(zero), np.flatnonzero(~zero)
    k = max(1, 63 // depth)
    key = np.zeros(len(p), np.uint64)
    alive = np.ones(len(p), bool)
    for j in range(k):
        at = p + j
        s = np.where(alive & (at < n), x[np.minimum(at, n - 1)], 0)
        alive &= s > 0
        key = (key << np.uint64(depth)) | s.astype(np.uint64)
    order = np.argsort(key)
    p, key, alive = p[order], key[order], alive[order]
    rank = np.empty(n + 1, np.int64)
    rank[z] = np.arange(len(z))
    rank[n] = -1
    new = np.ones(len(p), bool)
    new[1:] = key[1:] != key[:-1]
    group = np.maximum.accumulate(np.where(new, np.arange(len(p)), 0))
    # suffixes that end within the key are told apart by their places
    size = np.diff(np.append(np.flatnonzero(new), len(p)))[np.cumsum(new) - 1] if len(p) else np.zeros(0, np.int64)
    ended = np.flatnonzero((size > 1) & ~alive)
    if len(ended):
        o = np.lexsort((p[ended], group[ended]))
        p[ended] = p[ended][o]
        group[ended] = ended
    rank[p] = group + len(z)
    open_ = np.flatnonzero((size > 1) & alive)
    h = k
    while len(open_):
        q = p[open_]
        g = group[open_]
        r = rank[np.minimum(q + h, n)]
        o = np.lexsort((r, g))
        q, g2, r = q[o], g[o], r[o]
        p[open_] = q
        new = np.ones(len(q), bool)
        new[1:] = (g2[1:] != g2[:-1]) | (r[1:] != r[:-1])
        first = np.maximum.accumulate(np.where(new, np.arange(len(q)), 0))
        group[open_] = open_[first]
        rank[q] = group[open_] + len(z)
        size = np.diff(np.append(np.flatnonzero(new), len(q)))[np.cumsum(new) - 1]
        open_ = open_[size > 1]
        h *= 2
    return np.concatenate((z, p))


class FMIndex:
    """Counts and locates phrases of symbols from 1 to top in a text of symbols where 0 separates."""

    def __init__(self, x: np.ndarray, top: int) -> None:
        depth = max(1, int(top).bit_length())
        sa = suffix_order(x, depth)
        last = np.where(sa > 0, x[sa - 1], 0)
        counts = np.bincount(x, minlength=top + 1)
        self.n, self.top = len(x), top
        self.first = np.concatenate(([0], np.cumsum(counts)))  # rows before those that begin with a symbol
        self.tree = WaveletMatrix(last.astype(np.int64), depth)
        sampled = (sa % SAMPLE == 0) | (last == 0)
        self.marks, self.samples = Bits(sampled), sa[sampled]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of each phrase, as the first and past the last. phrases: one a row, from its end backwards, padded with 0."""
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n)
        for j in range(phrases.shape[1]):
            at = np.flatnonzero((j < lengths) & (lo < hi))
            if not len(at):
                break
            c = phrases[at, j]
            lo[at] = self.first[c] + self.tree.rank(c, lo[at])
            hi[at] = self.first[c] + self.tree.rank(c, hi[at])
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places in the text of the suffixes in these rows."""
        place = np.full(len(rows), -1, np.int64)
        left, steps_ = np.arange(len(rows)), 0
        rows = rows.copy()
        while len(left):
            done = self.marks.get(rows).astype(bool)
            place[left[done]] = self.samples[self.marks.rank(rows[done])] + steps_
            left, rows = left[~done], rows[~done]
            c = self.tree.symbol(rows)
            rows = self.first[c] + self.tree.rank(c, rows)
            steps_ += 1
        return place


def phrases_of(items: list[tuple[int | None, str | None]], size: int = PHRASE, least: int = MIN_ITEM):
    """Vocabulary (sorted word hashes), phrases of symbols from their ends backwards, their lengths, and the least item of each."""
    rows: dict[tuple[int, ...], int] = {}
    for item, text in items:
        h = text_words(text).tolist()
        k = min(size, len(h))
        if k < least:
            continue
        item = _NO_ITEM if item is None else int(item)
        for i in range(len(h) - k + 1):
            key = tuple(h[i : i + k])
            rows[key] = min(item, rows.get(key, _NO_ITEM))
    vocab = np.array(sorted({w for k in rows for w in k}), np.uint64)
    lengths = np.array([len(k) for k in rows], np.int64)
    phrases = np.zeros((len(rows), size), np.int64)
    for i, k in enumerate(rows):
        phrases[i, : len(k)] = np.searchsorted(vocab, np.array(k[::-1], np.uint64)) + 1
    return vocab, phrases, lengths, np.array(list(rows.values()), np.int64)


def symbols(h: np.ndarray, vocab: np.ndarray) -> np.ndarray:
    """1 and up for words of the vocabulary, 0 for others."""
    maybe = np.zeros(1 << 16, bool)
    maybe[(vocab >> np.uint64(48)).astype(np.int64)] = True
    at = np.flatnonzero(maybe[(h >> np.uint64(48)).astype(np.int64)])
    k = np.searchsorted(vocab, h[at])
    k[k == len(vocab)] = 0
    out = np.zeros(len(h), np.int64)
    out[at] = np.where(vocab[k] == h[at], k + 1, 0)
    return out


def shard_spans(parts: list[np.ndarray], bench) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Number of the text, first word, word past the end and least item of each span in texts given as arrays of word hashes."""
    vocab, phrases, lengths, items = bench
    none = np.zeros(0, np.int64)
    n = np.array([len(p) for p in parts])
    if not len(phrases) or not n.sum():
        return none, none, none, none
    begin = np.concatenate(([0], np.cumsum(n + 1)))
    h = np.concatenate(parts)
    x = np.zeros(begin[-1], np.int64)
    x[np.arange(len(h)) + np.repeat(np.arange(len(n)), n)] = symbols(h, vocab)
    fm = FMIndex(x, len(vocab))
    lo, hi = fm.search(phrases, lengths)
    count = hi - lo
    which = np.repeat(np.arange(len(count)), count)
    if not len(which):
        return none, none, none, none
    rows = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + lo[which]
    at = fm.locate(rows)
    order = np.argsort(at, kind="stable")
    at, which = at[order], which[order]
    end = np.maximum.accumulate(at + lengths[which])
    new = np.ones(len(at), bool)
    new[1:] = at[1:] > end[:-1]  # a separator stands between documents, so spans never touch across them
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    doc = np.searchsorted(begin, at[first], "right") - 1
    return doc, at[first] - begin[doc], end[last] - begin[doc], np.minimum.reduceat(items[which], first)


def _shards(batches: Iterator[pa.RecordBatch], text: str):
    """Lists of parts of batches, with bytes and words, for one shard each."""
    held, total = [], 0
    for batch, b, o in steps(batches, text):
        w = words(b, o)
        held.append((batch, b, o, *w))
        total += len(w[0])
        if total >= SHARD_WORDS:
            yield held
            held, total = [], 0
    if held:
        yield held


def _found(held, bench):
    """Spans of a shard, by the part and the text within it."""
    parts = [x[3][x[6][i] : x[6][i + 1]] for x in held for i in range(len(x[2]) - 1)]
    return shard_spans(parts, bench)


def _report(bench):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _shards(batches, "text"):
            doc, a, z, item = _found(held, bench)
            if len(doc):
                ids = np.concatenate([x[0].column(0).to_numpy() for x in held])
                yield pa.record_batch({"doc_id": ids[doc], "start_word": a.astype(np.int32), "end_word": z.astype(np.int32), "item_id": pa.array(item, mask=item == _NO_ITEM)})

    return run


_SPANS = "doc_id long, start_word int, end_word int, item_id long"


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for t in sorted_runs(batches, "doc_id"):
        d, a, z = (t.column(c).to_numpy() for c in ("doc_id", "start_word", "end_word"))
        item = t.column("item_id").fill_null(_NO_ITEM).to_numpy()
        new = np.ones(len(d), bool)
        for i in range(1, len(d)):  # few rows: spans of a benchmark of several slices
            if d[i] == d[i - 1]:
                new[i] = a[i] > z[i - 1]
                if not new[i]:
                    z = z.copy() if not z.flags.writeable else z
                    z[i] = max(z[i], z[i - 1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(d)) - 1
        least = np.minimum.reduceat(item, first)
        yield pa.record_batch({"doc_id": d[first], "start_word": a[first], "end_word": z[last], "item_id": pa.array(least, mask=least == _NO_ITEM)})


def _slices(benchmark: DataFrame, slice_words: int) -> Iterator[tuple[bool, tuple]]:
    """What phrases_of() gives for each slice of the benchmark that is small enough to send to the executors, one at a time, and whether it is the last."""
    t, at = numbered(benchmark)
    b = t.select(F.col(at["item_id"]).try_cast("long").alias("item_id"), F.col(at["text"]).cast("string").alias("text")).where("text is not null")
    size = b.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-size // (6 * slice_words)))
    for k in range(n):
        part = b if n == 1 else b.where(F.pmod(F.xxhash64("text"), F.lit(n)) == k)
        yield k == n - 1, phrases_of([(r[0], r[1]) for r in part.toLocalIterator()])


def leak_spans(docs: DataFrame, benchmark: DataFrame, slice_words: int = SLICE_WORDS) -> DataFrame:
    """(doc_id, start_word, end_word, item_id): the spans of each document that are made of phrases of the benchmark.

    The spans of each slice of a large benchmark are written before the next slice is built, so that the driver holds one.
    """
    ship_package(docs.sparkSession)
    d = docs_of(docs)
    both = None
    for last, bench in _slices(benchmark, slice_words):
        part = d.mapInArrow(_report(bench), _SPANS)
        if last and both is None:
            return part
        part = cut(part, "slice")
        both = part if both is None else both.unionAll(part)
    return both.repartition(F.col("doc_id")).sortWithinPartitions("doc_id", "start_word", "end_word").mapInArrow(_merge, _SPANS)


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same spans in order, those that overlap or touch as one."""
    out: list[tuple[int, int]] = []
    for x, y in sorted(spans):
        if out and x <= out[-1][1]:
            out[-1] = (out[-1][0], max(y, out[-1][1]))
        else:
            out.append((x, y))
    return out


def _cutting(bench, last: bool):
    """Adds a slice's spans to those in __q_spans (starts and ends by turns); the last slice's cuts them all from the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _shards(batches, "__q_text"):
            doc, a, z, _ = _found(held, bench)
            spans: dict[int, list] = {}
            for i, x, y in zip(doc.tolist(), a.tolist(), z.tolist(), strict=True):
                spans.setdefault(i, []).append((x, y))
            base = 0
            for batch, b, o, _h, s, e, ptr in held:
                k = batch.schema.get_field_index("__q_text")
                for i, flat in enumerate(batch.column(k + 1).to_pylist()):
                    if flat:
                        spans[base + i] = _merged([*zip(flat[::2], flat[1::2], strict=True), *spans.get(base + i, [])])
                if not last:
                    flat = pa.array([[v for p in spans[base + i] for v in p] if base + i in spans else None for i in range(batch.num_rows)], pa.list_(pa.int32()))
                    base += batch.num_rows
                    yield pa.record_batch([*batch.columns[: k + 1], flat], names=batch.schema.names)
                    continue
                hit = [i for i in range(batch.num_rows) if base + i in spans]
                text, flag = batch.column(k), pa.array([False] * batch.num_rows)
                if hit:
                    at = np.array(hit)
                    texts = cut_text(b, o, [spans.get(base + i) for i in range(batch.num_rows)], ptr, s, e)
                    mask = np.zeros(batch.num_rows, bool)
                    mask[at] = True
                    flag = pa.array(mask)
                    text = pa.array(texts, pa.string())
                base += batch.num_rows
                yield pa.record_batch([*batch.columns[:k], text, flag], names=[*batch.schema.names[:k], "__q_text", "__q_hit"])

    return run


def remove_leaks(docs: DataFrame, benchmark: DataFrame, slice_words: int = SLICE_WORDS) -> DataFrame:
    """docs with the spans of leak_spans() cut out, and n_chars, where there is one, set to the new length. A document of which no word is left goes; the others stay, with their other columns as they were."""
    ship_package(docs.sparkSession)
    d, at = numbered(docs)
    text = at["text"]
    t = d.withColumn("__q_text", F.col(text).cast("string")).withColumn("__q_spans", F.lit(None).cast("array<int>"))
    schema = t.drop("__q_spans").withColumn("__q_hit", F.lit(False)).schema
    held = None
    for last, bench in _slices(benchmark, slice_words):  # all slices look at the uncut text
        if last:
            t = t.mapInArrow(_cutting(bench, True), schema)
        else:
            new = cut(t.mapInArrow(_cutting(bench, False), t.schema), "slice")
            drop_cut(held)
            t = held = new
    t = t.where(~F.col("__q_hit") | F.col("__q_text").rlike(r"[\p{L}\p{N}]"))
    new = t.withColumn(text, F.when(F.col("__q_hit"), F.col("__q_text")).otherwise(F.col(text)))
    if "n_chars" in at:
        n = at["n_chars"]
        new = new.withColumn(n, F.when(F.col("__q_hit"), F.length(text)).otherwise(F.col(n)).cast(d.schema[n].dataType))
    return new.select(*d.columns).toDF(*docs.columns)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leak_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_WORDS_SQL = """CASE WHEN text IS NULL THEN [] ELSE regexp_extract_all(lower(text), '[a-z0-9\\x{00C0}-\\x{1FFF}\\x{2080}-\\x{10FFFF}]+') END"""

SQL2 = f"""
WITH b AS (SELECT item_id, {_WORDS_SQL} AS w FROM benchmark),
bi AS (SELECT item_id, w, least({PHRASE}, len(w)) AS k FROM b WHERE len(w) >= {MIN_ITEM}),
p AS (SELECT k, array_to_string(w[i : i + k - 1], ' ') AS phrase, min(item_id) AS item_id
      FROM bi, unnest(generate_series(1, len(w) - k + 1)) AS t(i) GROUP BY 1, 2),
ks AS (SELECT DISTINCT k FROM p),
d AS (SELECT doc_id, {_WORDS_SQL} AS w FROM documents WHERE doc_id IS NOT NULL),
g AS (SELECT doc_id, k, i, array_to_string(w[i : i + k - 1], ' ') AS phrase
      FROM d, ks, unnest(generate_series(1, len(w) - k + 1)) AS t(i)),
h AS (SELECT doc_id, i - 1 AS a, i - 1 + k AS z, item_id FROM g JOIN p USING (k, phrase)),
m AS (SELECT *, CASE WHEN a <= max(z) OVER (PARTITION BY doc_id ORDER BY a, z ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM h),
n AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY a, z ROWS UNBOUNDED PRECEDING) AS span FROM m)
SELECT doc_id, CAST(min(a) AS INTEGER) AS start_word, CAST(max(z) AS INTEGER) AS end_word, min(item_id) AS item_id
FROM n GROUP BY doc_id, span
"""
