"""Which texts contain which phrases, without comparing every text with every phrase.

Phrases go to the tasks in slices of SLICE_BYTES at most, however many there are; texts stay where they are. A window's size is the
greatest power of two that a phrase has in bytes (MOST at most), and a phrase is keyed by the hashes of its first and its last window,
which meet or overlap: by all of its bytes up to twice MOST. A task hashes all windows of these sizes of its texts, passes over those
that begin no phrase by a table of bits, and compares those that hit byte by byte, all in vectorised steps; only phrases of twice MOST and
more, keyed by so many first bytes, are compared one at a time. As bytes of UTF-8 begin characters unambiguously, bytes that match are
characters that match. Null texts contain nothing, and empty phrases are in no text.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import cut, ship_package

SLICE_BYTES = 16 << 20
MOST = 32
_STEP = 1 << 17
_TEXTS = 4 << 20
_LUT = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ODD = np.random.default_rng(6).integers(1, 1 << 63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _hashes(b: np.ndarray, most: int) -> Iterator[tuple[int, np.ndarray]]:
    """(size, hash of the window of so many bytes from each place) for sizes 1, 2, 4 and so on."""
    h, q = _LUT[b], 1
    for c in _ODD:
        yield q, h
        if 2 * q > most or len(h) <= q:
            return
        h = (h[:-q] ^ (h[:-q] >> np.uint64(29))) * c + h[q:]
        q *= 2


def _joined(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    return (first ^ (first >> np.uint64(31))) * _ODD[-1] + last


class _Seen:
    """Hashes that may be among some keys; few others, as the table has 32 bits a key up to 4 million."""

    def __init__(self, keys: np.ndarray) -> None:
        bits = min(22, max(12, (32 * len(keys)).bit_length()))
        self.shift, self.table = np.uint64(64 - bits), np.zeros(1 << bits, bool)
        self.table[keys >> self.shift] = True

    def maybe(self, h: np.ndarray) -> np.ndarray:
        return np.flatnonzero(self.table[(h >> self.shift).view(np.int64)])


def _each(starts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1 and so on, n[0] of them, then those of starts[1]."""
    return np.arange(n.sum()) + np.repeat(starts - np.cumsum(n) + n, n)


class Phrases:
    """Some phrases, keyed by the hashes of their bytes; a phrase that is there twice is looked up once."""

    def __init__(self, phrases: list[str]) -> None:
        ids: dict[bytes, int] = {}
        which = np.array([ids.setdefault(p.encode(), len(ids)) for p in phrases], np.int64)
        self.raw = list(ids)
        self.members = np.argsort(which, kind="stable")
        self.starts = np.searchsorted(which[self.members], np.arange(len(ids) + 1))
        spans = np.array([min(len(r), 2 * MOST) for r in self.raw], np.int64)
        self.reach = int(spans.max(initial=0))
        #: by the window's size: which windows begin a phrase, and by bytes keyed: which pairs may be a phrase, the keys in order, their phrases and these bytes
        self.at: dict[int, tuple[_Seen, dict[int, tuple[_Seen, np.ndarray, np.ndarray, np.ndarray]]]] = {}
        first: dict[int, list[np.ndarray]] = {}
        for n in sorted(set(spans.tolist()) - {0}):
            q, who = min(MOST, 1 << (n.bit_length() - 1)), np.flatnonzero(spans == n)
            rows = np.frombuffer(b"".join(self.raw[i][:n] for i in who), np.uint8)
            h = next(h for size, h in _hashes(rows, q) if size == q)
            keys = _joined(h[::n], h[n - q :: n])
            order = np.argsort(keys, kind="stable")
            first.setdefault(q, []).append(h[::n])
            by = self.at[q][1] if q in self.at else {}
            self.at[q] = (_Seen(np.concatenate(first[q])), by | {n: (_Seen(keys), keys[order], who[order], rows.reshape(-1, n)[order])})

    def within(self, b: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(text, phrase) pairs, once each, of texts that stand one after another."""
        found, most, data = [np.zeros(0, np.int64)], max(self.at, default=0), memoryview(b)
        for lo in range(0, len(b) if most else 0, _STEP):
            for q, h in _hashes(b[lo : lo + _STEP + self.reach - 1], most):
                if q not in self.at:
                    continue
                begins, by = self.at[q]
                begin = begins.maybe(h[:_STEP])
                for n, (seen, keys, who, rows) in by.items():
                    at = begin[: np.searchsorted(begin, len(h) - (n - q))]
                    key = _joined(h[at], h[at + (n - q)])
                    some = seen.maybe(key)
                    left, right = np.searchsorted(keys, key[some]), np.searchsorted(keys, key[some], "right")
                    at = at[some] + lo
                    doc = np.searchsorted(offsets, at, "right") - 1
                    some = np.flatnonzero((right > left) & (at + n <= offsets[doc + 1]))
                    left, right, at, doc = left[some], right[some], at[some], doc[some]
                    if n == 2 * MOST:
                        found.append(self._long(data, offsets, at, doc, left, right, who))
                        continue
                    while len(at):  # a second time only where hashes of different phrases are equal
                        same = (np.lib.stride_tricks.sliding_window_view(b, n)[at] == rows[left]).all(axis=1)
                        found.append(np.unique(doc[same] * len(self.raw) + who[left[same]]))
                        left = left + 1
                        more = left < right
                        left, right, at, doc = left[more], right[more], at[more], doc[more]
        doc, phrase = np.divmod(np.unique(np.concatenate(found)), max(1, len(self.raw)))
        n = self.starts[phrase + 1] - self.starts[phrase]
        return np.repeat(doc, n), self.members[_each(self.starts[phrase], n)]

    def _long(self, data: memoryview, offsets: np.ndarray, at: np.ndarray, doc: np.ndarray, left: np.ndarray, right: np.ndarray, who: np.ndarray) -> np.ndarray:
        """Pairs of texts and phrases as numbers, of places with the first bytes of the phrases from left to right."""
        pairs: set[int] = set()
        for place, d, end, lo, hi in zip(at.tolist(), doc.tolist(), offsets[doc + 1].tolist(), left.tolist(), right.tolist(), strict=True):
            for w in who[lo:hi].tolist():
                raw = self.raw[w]
                if (pair := d * len(self.raw) + w) not in pairs and place + len(raw) <= end and data[place : place + len(raw)] == raw:
                    pairs.add(pair)
        return np.array(sorted(pairs), np.int64)


def _pieces(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, their bytes, each one's place there) of texts of about _TEXTS bytes at a time, one at least."""
    texts = texts.fill_null("").cast(pa.large_string())
    _, places, data = texts.buffers()
    total = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    raw, lo = np.frombuffer(data, np.uint8) if data and data.size else np.zeros(0, np.uint8), 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(total, total[lo] + _TEXTS, "right")) - 1)
        yield lo, hi, raw[total[lo] : total[hi]], total[lo : hi + 1] - total[lo]
        lo = hi


def _search(sent, names: tuple[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, phrases = sent.value
        index = Phrases(phrases)
        for batch in batches:
            for lo, hi, raw, offsets in _pieces(batch.column(1)):
                doc, phrase = index.within(raw, offsets)
                yield pa.record_batch({names[0]: keys.take(pa.array(phrase)), names[1]: batch.column(0).slice(lo, hi - lo).take(pa.array(doc))})

    return run


def _count(sent, names: tuple[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, phrases = sent.value
        index, n = Phrases(phrases), np.zeros(len(phrases), np.int64)
        for batch in batches:
            for _, _, raw, offsets in _pieces(batch.column(0)):
                n += np.bincount(index.within(raw, offsets)[1], minlength=len(n))
        some = np.flatnonzero(n)
        yield pa.record_batch({names[0]: keys.take(pa.array(some)), names[1]: pa.array(n[some])})

    return run


def _slices(phrases: DataFrame, key: str, phrase: str, slice_bytes: int) -> Iterator:
    """Keys and phrases as sent to the tasks, a slice at a time."""
    spark = phrases.sparkSession
    ship_package(spark)
    p = phrases.select(F.col(key), F.col(phrase).alias("__p")).where(F.length("__p") > 0).distinct()
    n = p.agg(F.sum(F.octet_length("__p") + 64)).first()[0] or 0
    slices = max(1, -(-int(n) // slice_bytes))
    if slices > 1:
        p = cut(p, "phrases")
    for i in range(slices):
        t = p.where(F.pmod(F.xxhash64("__p"), F.lit(slices)) == i).toArrow()
        yield spark.sparkContext.broadcast((t.column(0).combine_chunks(), t.column(1).to_pylist()))


def containing(docs: DataFrame, phrases: DataFrame, doc: str, text: str, key: str, phrase: str, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """(key, doc) of the phrases and the texts that contain them. Phrases with the same key count as one where both are in a text only if they are the same phrase."""
    x = docs.select(F.col(doc), F.col(text).cast("string"))
    schema = f"`{key}` {phrases.schema[key].dataType.simpleString()}, `{doc}` {x.schema[doc].dataType.simpleString()}"
    return functools.reduce(DataFrame.unionByName, [x.mapInArrow(_search(sent, (key, doc)), schema) for sent in _slices(phrases, key, phrase, slice_bytes)])


def frequency(docs: DataFrame, phrases: DataFrame, text: str, key: str, phrase: str, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """(key, df): how many rows containing() has of a key that is there; a task counts its own texts, and only its counts leave it."""
    x = docs.select(F.col(text).cast("string"))
    schema = f"`{key}` {phrases.schema[key].dataType.simpleString()}, df bigint"
    n = functools.reduce(DataFrame.unionByName, [x.mapInArrow(_count(sent, (key, "df")), schema) for sent in _slices(phrases, key, phrase, slice_bytes)])
    return n.groupBy(key).agg(F.sum("df").alias("df"))
