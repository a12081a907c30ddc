"""Vectorised text primitives shared by the operators of this subpackage.

Text reaches Python as Arrow batches; the functions here work on the UTF-8 bytes of a whole batch at once with numpy,
without a Python object per document or word.

A *word* is a maximal run of ASCII letters and digits and of non-ASCII bytes, where the characters U+00A0..U+00BF and
U+2000..U+207F (spaces and punctuation) separate. Words are compared after case folding of ASCII, Latin-1, Greek and
Cyrillic letters, none of which changes the length in bytes. A null text has no words, like an empty one.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_U = np.uint64
_PIECE = 1 << 18
#: Text bytes that one vectorised step looks at; bounds a worker's memory whatever a batch holds.
STEP_BYTES = 1 << 20

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_WORD = np.zeros(256, bool)
for _lo, _hi in ((48, 58), (97, 123), (128, 256)):
    _WORD[_lo:_hi] = True
_rng = np.random.default_rng(20240229)
_LUT = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_LUT[~_WORD] = 0
_MULT = 0x9E3779B97F4A7C15 | 1
_INV = pow(_MULT, -1, 1 << 64)
_tables: dict[str, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """mult**i modulo 2**64 (or its inverse) for i < n at least."""
    key = "inv" if inverse else "pow"
    if key not in _tables or len(_tables[key]) < n:
        size = max(1 << 19, 1 << int(n - 1).bit_length())
        a = np.full(size, _INV if inverse else _MULT, np.uint64)
        a[0] = 1
        _tables[key] = np.multiply.accumulate(a)
    return _tables[key]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser with full avalanche (splitmix64)."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def fold(b: np.ndarray) -> np.ndarray:
    """Case-folded copy of UTF-8 bytes; the length stays."""
    out = _FOLD[b]
    if len(b) < 2 or not (b >= 0xC3).any():
        return out
    lead, nxt = b[:-1], b[1:]
    at = np.flatnonzero((lead == 0xC3) & (nxt >= 0x80) & (nxt <= 0x9E) & (nxt != 0x97)) + 1
    out[at] += 32
    if ((lead == 0xCE) | (lead == 0xD0)).any():
        at = np.flatnonzero((lead == 0xCE) & (nxt >= 0x91) & (nxt <= 0x9F)) + 1
        out[at] += 32
        at = np.flatnonzero((lead == 0xCE) & (nxt >= 0xA0) & (nxt <= 0xA9))
        out[at] = 0xCF
        out[at + 1] -= 32
        at = np.flatnonzero((lead == 0xD0) & (nxt >= 0x90) & (nxt <= 0x9F)) + 1
        out[at] += 32
        at = np.flatnonzero((lead == 0xD0) & (nxt >= 0xA0) & (nxt <= 0xAF))
        out[at] = 0xD1
        out[at + 1] -= 32
        at = np.flatnonzero((lead == 0xD0) & (nxt >= 0x80) & (nxt <= 0x8F))
        out[at] = 0xD1
        out[at + 1] += 16
    return out


def word_mask(f: np.ndarray) -> np.ndarray:
    """True at bytes of words, of folded bytes."""
    w = _WORD[f]
    if (f == 0xC2).any():
        at = np.flatnonzero((f[:-1] == 0xC2) & (f[1:] >= 0xA0))
        w[at] = w[at + 1] = False
    if (f == 0xE2).any() and len(f) > 2:
        at = np.flatnonzero((f[:-2] == 0xE2) & ((f[1:-1] == 0x80) | (f[1:-1] == 0x81)))
        w[at] = w[at + 1] = w[at + 2] = False
    return w


def words(b: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and byte past the end of every word, and for each text the number of words before it (one entry more than texts).

    b: the bytes of all texts, one after another; offsets: where each begins, and the end.
    """
    n = len(b)
    hs, ss, es = [], [], []
    lo = 0
    while lo < n:
        hi = min(n, lo + _PIECE)
        if hi < n:  # end a piece at a byte that can't be within a character or word
            back = b[lo:hi][::-1]
            stop = np.flatnonzero((back < 128) & ~_WORD[_FOLD[back]])[:1]
            if len(stop) == 0:
                ahead = b[hi:]
                stop = np.flatnonzero((ahead < 128) & ~_WORD[_FOLD[ahead]])[:1]
                hi = n if len(stop) == 0 else hi + int(stop[0]) + 1
            else:
                hi -= int(stop[0])
        f = fold(b[lo:hi])
        w = word_mask(f)
        edge = np.empty(len(f) + 1, bool)
        edge[0] = edge[-1] = True
        np.not_equal(w[1:], w[:-1], out=edge[1:-1])
        inner = offsets[(offsets > lo) & (offsets < hi)] - lo
        edge[inner] = True
        at = np.flatnonzero(edge)
        first = at[:-1]
        keep = w[first]
        s, e = first[keep], at[1:][keep]
        if len(s):
            v = _LUT[f]
            v[~w] = 0
            v *= powers(len(f))[: len(f)]
            h = np.add.reduceat(v, s)
            h *= powers(len(f), True)[s]
            hs.append(mix(h))
            ss.append(s + lo)
            es.append(e + lo)
        lo = hi
    if not hs:
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), z, z, np.zeros(len(offsets), np.int64)
    s = np.concatenate(ss)
    return np.concatenate(hs), s, np.concatenate(es), np.searchsorted(s, offsets)


def text_words(text: str | None) -> np.ndarray:
    """Word hashes of one text, as in words()."""
    raw = np.frombuffer((text or "").encode(), np.uint8)
    return words(raw, np.array([0, len(raw)]))[0]


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of the window of so many words that begins at each place; too few places are left at the end. Windows may cross texts: the caller drops those."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * powers(len(h))[: len(h)], out=total[1:])
    return mix((total[size:] - total[:-size]) * powers(n, True)[:n] + _U(size))


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column, without a copy where there are no nulls."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    off_type = np.int64 if pa.types.is_large_string(col.type) else np.int32
    _, off, data = col.buffers()
    o = np.frombuffer(off, off_type)[col.offset : col.offset + len(col) + 1].astype(np.int64) if off is not None and len(col) else np.zeros(len(col) + 1, np.int64)
    b = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return b[o[0] : o[-1]], o - o[0]


def steps(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = STEP_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of the batches with about so many bytes of text each (one text at least), with the bytes and offsets of that column."""
    try:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            b, o = buffers(batch.column(batch.schema.get_field_index(text)))
            lo = 0
            while lo < batch.num_rows:
                hi = max(lo + 1, int(np.searchsorted(o, o[lo] + most, "right")) - 1)
                yield batch.slice(lo, hi - lo), b[o[lo] : o[hi]], o[lo : hi + 1] - o[lo]
                lo = hi
    finally:
        release()


def release() -> None:
    """Give memory that a task has freed back to the system: Python workers live on for later tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # a C library without it
        pass


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as a signed number, for Spark."""
    return x.view(np.int64)


def numbered(df) -> tuple:
    """df with its columns named c0, c1 and so on, and the new name of each: whatever a table's columns are called, with dots, twice or like an operator's own, they can't clash."""
    at = {}
    for i, c in enumerate(df.columns):
        at.setdefault(c, f"c{i}")
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]), at


def docs_of(df, *extra: str):
    """doc_id (as a long), text and further columns (as strings; null where df has none) of the rows that have a doc_id; one that is no number is none."""
    from pyspark.sql import functions as F

    t, at = numbered(df)
    more = [F.col(at[c]).cast("string").alias(c) if c in at else F.lit(None).cast("string").alias(c) for c in extra]
    return t.select(F.col(at["doc_id"]).try_cast("long").alias("doc_id"), F.col(at["text"]).cast("string").alias("text"), *more).where(F.col("doc_id").isNotNull())


def once(df):
    """df with one row of those that repeat a doc_id: the one with the least text (nulls after all), of these the least by all columns as JSON, whatever the order of rows. Rows without a doc_id stay as they are.

    Only repeated rows are shuffled, and combined before that, so a doc_id of very many rows is no burden to a task.
    """
    from pyspark.sql import functions as F

    from quarry.session import cut, small_side

    t, at = numbered(df)
    key = F.col(at["doc_id"])
    again = cut(t.where(key.isNotNull()).groupBy(key.alias("again")).count().where("count > 1").select("again"), "again")
    if again.isEmpty():
        return df
    again = small_side(again)
    text = F.col(at["text"]).cast("string")
    least = F.min_by(F.struct(*t.columns), F.struct(text.isNull().alias("none"), text.alias("text"), F.to_json(F.struct(*t.columns)).alias("row")))
    more = t.join(again, key == F.col("again"), "left_semi").groupBy(key.alias("again")).agg(least.alias("row")).select("row.*")
    return t.join(again, key == F.col("again"), "left_anti").unionByName(more).toDF(*df.columns)


def prefixes(b: np.ndarray, s: np.ndarray, e: np.ndarray, sizes: tuple[int, ...]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each size the words (their numbers) longer than so many bytes, and the hash of their first bytes; b: folded bytes, s and e: where words begin and end."""
    h = np.zeros(len(s), np.uint64)
    which, first = np.arange(len(s)), s
    for j in range(max(sizes)):
        long = e[which] - first > j + 1 if j + 1 in sizes else e[which] - first > j
        which, first, h = which[long], first[long], h[long]
        h = mix(h * _U(_MULT) + b[first + j].astype(np.uint64) + _U(1))
        if j + 1 in sizes:
            yield which, mix(h + _U(j))


def sorted_runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables that hold whole runs of equal keys, of batches in the order of the key: what follows needs no more memory than a batch and the longest run."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        k = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        first = int(np.searchsorted(k, k[-1], "left"))
        if first == 0 and rest and rest[-1].column(rest[-1].schema.get_field_index(key))[-1].as_py() == k[0]:
            rest.append(batch)
            continue
        done = [*rest, batch.slice(0, first)] if first else rest
        if done:
            yield pa.Table.from_batches(done)
        rest = [batch.slice(first)]
    if rest:
        yield pa.Table.from_batches(rest)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """Tables that hold whole groups of equal keys, of batches in their order."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        same = np.ones(batch.num_rows, bool)
        for k in keys:
            c = batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False)
            same &= c == c[-1]
        other = np.flatnonzero(~same)
        cutoff = int(other[-1]) + 1 if len(other) else 0  # rows before it are of groups that end in this batch
        if cutoff == 0 and rest and all(rest[-1].column(rest[-1].schema.get_field_index(k))[-1].as_py() == batch.column(batch.schema.get_field_index(k))[0].as_py() for k in keys):
            rest.append(batch)
            continue
        done = [*rest, batch.slice(0, cutoff)] if cutoff else rest
        if done:
            yield pa.Table.from_batches(done)
        rest = [batch.slice(cutoff)]
    if rest:
        yield pa.Table.from_batches(rest)
