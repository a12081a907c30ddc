"""Byte-level BPE encoding and decoding with a pair occurrence index.

The text is split into pre-tokens as the vocabulary's pattern says, by vectorised character classes. The distinct
pre-tokens of a part of a partition that the worker has not met yet are laid out as one sequence of symbols, and an
index maps each pair of neighbours that has a merge rank to all its places. The active ranks are applied in ascending
order from a heap; a merge at all places of a pair at once removes the right-hand symbols and adds the pairs that arise
to the lists of their ranks. Merges never cross pre-tokens, so the result is that of encoding each one alone.

Defined results: a null or empty text has no ids; every byte sequence has a symbol, so nothing is unknown, and decoding
gives the very bytes back; strings of special tokens are ordinary text. Rows are encoded one by one, whatever their
doc_id (null or repeated). A text of any length is encoded whole; equal ranks can't be, so there are no ties. Other columns,
whatever their names, are not looked at. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
import json
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import mix, powers, steps
from quarry.session import ship_package

#: Place of the vocabulary on the driver; executors get its arrays from there.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
#: Text bytes whose unknown pre-tokens share one index, and the most pre-tokens that a worker remembers.
PART_BYTES, REMEMBER = 8 << 20, 250_000

_L, _N, _S, _O = 0, 1, 2, 3
_SPACES = {*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000}
_kinds: list[np.ndarray] = []
_BYTES = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def kinds() -> np.ndarray:
    """Letter, number, space or other, of each code point."""
    if not _kinds:
        k = np.full(sys.maxunicode + 1, _O, np.uint8)
        for c in range(sys.maxunicode + 1):
            g = unicodedata.category(chr(c))[0]
            if g == "L":
                k[c] = _L
            elif g == "N":
                k[c] = _N
        k[list(_SPACES)] = _S
        _kinds.append(k)
    return _kinds[0]


def byte_kinds(b: np.ndarray) -> np.ndarray:
    """The kind of the character that each byte belongs to."""
    table = kinds()
    k = table[b]
    high = np.flatnonzero(b >= 0xC0)
    if len(high):
        lead = b[high].astype(np.int64)
        width = np.where(lead >= 0xF0, 4, np.where(lead >= 0xE0, 3, 2))
        cp = lead & np.where(width == 4, 7, np.where(width == 3, 15, 31))
        for j in (1, 2, 3):
            use = width > j
            cp[use] = (cp[use] << 6) | (b[np.minimum(high[use] + j, len(b) - 1)] & 63)
        kind = table[np.minimum(cp, sys.maxunicode)]
        for j in range(4):
            use = width > j
            k[np.minimum(high[use] + j, len(b) - 1)] = kind[use]
    return k


def pretokens(b: np.ndarray, o: np.ndarray) -> np.ndarray:
    """First byte of each pre-token of texts that begin at the offsets o (the last of which is the end)."""
    n = len(b)
    if n == 0:
        return np.zeros(0, np.int64)
    k = byte_kinds(b)
    begin = np.zeros(n + 1, bool)
    begin[0] = begin[n] = True
    np.not_equal(k[1:], k[:-1], out=begin[1:n])
    edge = np.zeros(n + 1, bool)
    edge[o] = True
    begin |= edge
    # the last character of a run of spaces before another kind stands apart; a blank joins what follows
    run = np.flatnonzero(begin)
    s, e = run[:-1], run[1:]
    spaces = (k[s] == _S) & ~edge[e]
    s, e = s[spaces], e[spaces]
    last = e - 1
    cont = (b[last] & 0xC0) == 0x80
    while cont.any():
        last = np.where(cont, last - 1, last)
        cont = (b[last] & 0xC0) == 0x80
    begin[last] = True
    blank = b[last] == 32
    begin[e[blank]] = False
    # contractions: an apostrophe that begins a pre-token, and s, t, m, d, re, ve or ll after it
    q = np.flatnonzero((b == 39) & begin[:n])
    if len(q):
        x, y = b[np.minimum(q + 1, n - 1)], b[np.minimum(q + 2, n - 1)]
        in1, in2 = (q + 1 < n) & ~edge[np.minimum(q + 1, n)], (q + 2 < n) & ~edge[np.minimum(q + 2, n)]
        one = in1 & np.isin(x, np.frombuffer(b"stmd", np.uint8))
        two = in1 & in2 & ~one & (((y == 101) & ((x == 114) | (x == 118))) | ((x == 108) & (y == 108)))
        for at, width in ((q[one], 2), (q[two], 3)):
            begin[at + 1] = False
            begin[at + width] = True
    return np.flatnonzero(begin[:n])


class Vocabulary:
    """Merges and token bytes as arrays, small enough to send along with a task."""

    def __init__(self, path: str = VOCABULARY) -> None:
        model = json.load(open(path, encoding="utf-8"))["model"]
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        to_byte = {chr(c): c for c in shown}
        to_byte |= {chr(256 + i): c for i, c in enumerate(c for c in range(256) if c not in shown)}
        vocab = model["vocab"]
        raw = {i: bytes(to_byte[c] for c in t) for t, i in vocab.items()}
        top = max(raw) + 1
        self.offsets = np.concatenate(([0], np.cumsum([len(raw.get(i, b"")) for i in range(top)])))
        self.bytes = np.frombuffer(b"".join(raw.get(i, b"") for i in range(top)), np.uint8)
        self.single = np.array([vocab[c] for c in sorted(to_byte, key=to_byte.get)], np.int64)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.a = np.array([vocab[x] for x, _ in merges], np.int64)
        self.b = np.array([vocab[y] for _, y in merges], np.int64)
        self.made = np.array([vocab[x + y] for x, y in merges], np.int64)
        key = (self.a << 32) | self.b
        self.order = np.argsort(key)
        self.keys = key[self.order]

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merge ranks of pairs, -1 where there is none."""
        key = (a << 32) | b
        i = np.searchsorted(self.keys, key)
        i[i == len(self.keys)] = 0
        return np.where(self.keys[i] == key, self.order[i], -1)


def encode_pieces(v: Vocabulary, b: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the pieces of b that begin at these places, and where each piece's ids begin (one entry more)."""
    n = len(b)
    sym = v.single[b]
    right = np.arange(1, n + 1)
    left = np.arange(-1, n - 1)
    left[begin] = -1
    right[np.append(begin[1:], n) - 1] = -1
    alive = np.ones(n, bool)
    at = np.flatnonzero(right >= 0)
    rank = v.ranks(sym[at], sym[right[at]])
    at, rank = at[rank >= 0], rank[rank >= 0]
    lists: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []

    def add(rank: np.ndarray, at: np.ndarray) -> None:
        if not len(rank):
            return
        o = np.argsort(rank, kind="stable")
        rank, at = rank[o], at[o]
        first = np.flatnonzero(np.concatenate(([True], rank[1:] != rank[:-1])))
        for r, part in zip(rank[first].tolist(), np.split(at, first[1:]), strict=True):
            if r in lists:
                lists[r].append(part)
            else:
                lists[r] = [part]
                heapq.heappush(heap, r)

    add(rank, at)
    while heap:
        r = heapq.heappop(heap)
        parts = lists.pop(r)
        p = np.unique(np.concatenate(parts))
        a, c = v.a[r], v.b[r]
        q = right[p]
        ok = alive[p] & (sym[p] == a) & (q >= 0)
        ok &= sym[q] == c
        p, q = p[ok], q[ok]
        if not len(p):
            continue
        if a == c and len(p) > 1:  # of pairs that overlap, every other one from the left
            chained = np.concatenate(([False], p[1:] == q[:-1]))
            start = np.maximum.accumulate(np.where(chained, 0, np.arange(len(p))))
            keep = (np.arange(len(p)) - start) % 2 == 0
            p, q = p[keep], q[keep]
        sym[p] = v.made[r]
        alive[q] = False
        far = right[q]
        right[p] = far
        has = far >= 0
        left[far[has]] = p[has]
        before = left[p]
        x = before[before >= 0]
        y = p[has]
        places = np.concatenate((x, y))
        rank = v.ranks(sym[places], sym[right[places]])
        add(rank[rank >= 0], places[rank >= 0])
    ids = sym[alive]
    count = np.add.reduceat(alive.astype(np.int64), begin) if len(begin) else np.zeros(0, np.int64)
    return ids.astype(np.int32), np.concatenate(([0], np.cumsum(count)))


def ragged(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (count[0] of them), start[1], ..."""
    end = np.cumsum(count)
    return np.arange(end[-1] if len(end) else 0) + np.repeat(start - (end - count), count)


class Encoder:
    """Encodes parts of a partition, and remembers the ids of pre-tokens from part to part."""

    def __init__(self, v: Vocabulary) -> None:
        self.v = v
        self.forget()

    def forget(self) -> None:
        self.keys, self.start, self.count, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Number of each known pre-token; -1 for others."""
        if not len(self.keys):
            return np.full(len(h), -1)
        i = np.searchsorted(self.keys, h)
        i[i == len(self.keys)] = 0
        return np.where(self.keys[i] == h, i, -1)

    def learn(self, new: dict[int, bytes], needed: np.ndarray) -> None:
        """Encode distinct pieces together and remember them; when there are too many, all that this part doesn't need is forgotten."""
        if len(self.keys) + len(new) > REMEMBER and len(self.keys):
            i = self.find(needed)
            i = i[i >= 0]
            ids = self.ids[ragged(self.start[i], self.count[i])]
            self.keys, self.count = self.keys[i], self.count[i]
            self.start, self.ids = np.cumsum(self.count) - self.count, ids
        size = np.fromiter(map(len, new.values()), np.int64, len(new))
        ids, at = encode_pieces(self.v, np.frombuffer(b"".join(new.values()), np.uint8), np.cumsum(size) - size)
        keys = np.concatenate((self.keys, np.array(list(new), np.uint64)))
        start = np.concatenate((self.start, at[:-1] + len(self.ids)))
        count = np.concatenate((self.count, np.diff(at)))
        self.ids = np.concatenate((self.ids, ids))
        o = np.argsort(keys)
        self.keys, self.start, self.count = keys[o], start[o], count[o]

    def part(self, held: list[tuple]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of all texts and the number of ids of each, for parts of batches (bytes and offsets)."""
        seen, new = [], {}
        for b, o in held:
            begin = pretokens(b, o)
            if not len(begin):
                seen.append((begin, begin.astype(np.uint64), begin))
                continue
            lo, h = 0, np.zeros(len(begin), np.uint64)
            for lo in range(0, len(begin), 1 << 16):  # hashes by stretches, so that the tables of powers stay small
                hi = min(len(begin), lo + (1 << 16))
                z = begin[hi] if hi < len(begin) else len(b)
                x = _BYTES[b[begin[lo] : z]] * powers(z - begin[lo])[: z - begin[lo]]
                h[lo:hi] = mix(np.add.reduceat(x, begin[lo:hi] - begin[lo]) * powers(z - begin[lo], True)[begin[lo:hi] - begin[lo]])
            u, first, back = np.unique(h, return_index=True, return_inverse=True)
            seen.append((begin, u, back))
            unknown = np.flatnonzero(self.find(u) < 0)
            ends = np.append(begin[1:], len(b))
            raw = b.tobytes()
            for k, i in zip(u[unknown].tolist(), first[unknown].tolist(), strict=True):
                if k not in new:
                    new[k] = raw[begin[i] : ends[i]]
        if new:
            self.learn(new, np.unique(np.concatenate([u for _, u, _ in seen])))
        out = []
        for (b, o), (begin, u, back) in zip(held, seen, strict=True):
            if not len(begin):
                out.append((np.zeros(0, np.int32), np.zeros(len(o) - 1, np.int64)))
                continue
            i = self.find(u)[back]
            count = self.count[i]
            total = np.concatenate(([0], np.cumsum(count)))
            out.append((self.ids[ragged(self.start[i], count)], np.diff(total[np.searchsorted(begin, o)])))
        return out


def decode_bytes(v: Vocabulary, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of ids one after another, and the number of bytes of each."""
    size = np.diff(v.offsets)[ids]
    return v.bytes[ragged(v.offsets[ids], size)], size


_encoders: dict[str, Encoder] = {}


def _encode(v: Vocabulary, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _encoders:
            _encoders[name] = Encoder(v)
        coder = _encoders[name]

        def flush(held):
            for (batch, b, o), (ids, count) in zip(held, coder.part([(b, o) for _, b, o in held]), strict=True):
                raw, _ = decode_bytes(v, ids)
                same = np.array_equal(raw, b)
                at = np.concatenate(([0], np.cumsum(count)))
                size = np.diff(np.concatenate(([0], np.cumsum(np.diff(v.offsets)[ids])))[at])
                ok = np.diff(o) == size
                if not same:
                    ok = np.array([bool(k) and decode_bytes(v, ids[at[i] : at[i + 1]])[0].tobytes() == b[o[i] : o[i + 1]].tobytes() for i, k in enumerate(ok)])
                lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids))
                yield pa.record_batch([*batch.columns[:-1], lists, pa.array(count.astype(np.int32)), pa.array(ok)], names=[*batch.schema.names[:-1], "token_ids", "n_tokens", "round_trip"])

        held, size = [], 0
        for batch, b, o in steps(batches, "__q_text"):
            held.append((batch, b, o))
            size += len(b)
            if size >= PART_BYTES:
                yield from flush(held)
                held, size = [], 0
        if held:
            yield from flush(held)

    return run


def encode(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), path: str = VOCABULARY) -> DataFrame:
    """The kept columns, and token_ids, n_tokens and round_trip (whether decoding gave the very text back) of each row's text."""
    ship_package(docs.sparkSession)
    d = docs.select(*keep, F.col("text").cast("string").alias("__q_text"))
    schema = d.drop("__q_text").withColumns({"token_ids": F.array(F.lit(0)), "n_tokens": F.lit(0), "round_trip": F.lit(True)}).schema
    return d.mapInArrow(_encode(Vocabulary(path), path), schema)


def _decode(v: Vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            null = np.asarray(lists.is_null())
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            raw, size = decode_bytes(v, flat)
            count = np.where(null, 0, lists.value_lengths().fill_null(0).to_numpy())
            at = np.concatenate(([0], np.cumsum(size)))[np.concatenate(([0], np.cumsum(count)))]
            texts = [raw[i:j].tobytes().decode("utf-8", "replace") for i, j in zip(at[:-1], at[1:], strict=True)]
            yield pa.record_batch([*batch.columns[:-1], pa.array(texts, pa.string())], names=[*batch.schema.names[:-1], "text"])

    return run


def decode(rows: DataFrame, keep: tuple[str, ...] = ("doc_id",), path: str = VOCABULARY) -> DataFrame:
    """The kept columns and the text that the column token_ids stands for; null ids give an empty text."""
    ship_package(rows.sparkSession)
    d = rows.select(*keep, F.col("token_ids").cast("array<int>").alias("__q_ids"))
    return d.mapInArrow(_decode(Vocabulary(path)), d.drop("__q_ids").withColumn("text", F.lit("")).schema)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(spark.read.parquet(f"{sf_dir}/documents.parquet"))
