"""Token ids as bits: canonical Huffman codes of limited length from global counts, with blocks that decode on their own.

The ids of all documents are counted (each task counts its own, Spark adds the counts up; the table has at most one row
an id of the vocabulary), package-merge gives the best lengths of at most LIMIT bits, and codes are canonical: in the order of
(length, id). Each document is one bit string, begun at a byte, with the bit offset of every BLOCK-th id as a checkpoint.
Decoding looks LIMIT bits up in one table, for all blocks side by side.

Defined results: a null or empty text has no ids, no bits and no checkpoints; rows without a doc_id are left out; rows that repeat a
doc_id are coded one by one. If only one id occurs, its code is one bit long. An empty table gives no rows and an empty
codebook. Ties in counts go to the lesser id, so the codebook is the same for any order of rows. A text of any length is one bit string.
An id takes two bytes between the steps, so a vocabulary of more than 65,536 ids is an error. Other columns, whatever their names,
are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import bpe
from quarry.llm.common import docs_of, steps
from quarry.session import cut, ship_package

LIMIT = 18
BLOCK = 256


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Lengths of the best prefix code of at most limit bits for these counts; 0 where the count is 0 (package-merge)."""
    out = np.zeros(len(counts), np.int64)
    used = np.flatnonzero(counts)
    n = len(used)
    if n == 0:
        return out
    if n == 1:
        out[used] = 1
        return out
    if n > 1 << limit:
        raise ValueError("more symbols than codes of that length")
    order = used[np.lexsort((used, counts[used]))]
    weight = counts[order].astype(np.int64)
    leaves: list[np.ndarray] = []
    packages = np.zeros(0, np.int64)
    for _ in range(limit):
        both = np.concatenate((weight, packages))
        o = np.argsort(both, kind="stable")
        leaves.append(np.concatenate(([0], np.cumsum(o < n))))
        both = both[o]
        packages = both[: len(both) // 2 * 2].reshape(-1, 2).sum(1)
    take = 2 * n - 2
    for seen in reversed(leaves):
        k = int(seen[min(take, len(seen) - 1)])
        out[order[:k]] += 1
        take = 2 * (take - k)
    return out


class Codebook:
    """Codes and lengths by id, and the table that decodes."""

    def __init__(self, lengths: np.ndarray, limit: int = LIMIT) -> None:
        self.lengths, self.limit = lengths, limit
        used = np.flatnonzero(lengths)
        order = used[np.lexsort((used, lengths[used]))]
        span = np.int64(1) << (limit - lengths[order])
        first = np.cumsum(span) - span
        self.codes = np.zeros(len(lengths), np.uint64)
        self.codes[order] = (first >> (limit - lengths[order])).astype(np.uint64)
        self.table = np.zeros(1 << limit, np.int64)  # id and length together
        filled = np.repeat((order << 5) | lengths[order], span)
        self.table[: len(filled)] = filled

    def encode(self, ids: np.ndarray, ptr: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Bytes, where each document's begin, checkpoints (bits from the document's beginning), and where each document's begin."""
        size = self.lengths[ids]
        end = np.concatenate(([0], np.cumsum(size)))
        n = np.diff(ptr)
        bits = end[ptr[1:]] - end[ptr[:-1]]
        start = np.concatenate(([0], np.cumsum((bits + 7) // 8)))
        shift = start[:-1] * 8 - end[ptr[:-1]]
        at = end[:-1] + np.repeat(shift, n)
        words = np.zeros(int(start[-1]) // 8 + 2, np.uint64)
        if len(ids):
            code = self.codes[ids]
            w = at >> 6
            room = 64 - (at & 63) - size
            high = np.where(room >= 0, code << np.maximum(room, 0).astype(np.uint64), code >> np.maximum(-room, 0).astype(np.uint64))
            first = np.flatnonzero(np.concatenate(([True], w[1:] != w[:-1])))
            words[w[first]] = np.add.reduceat(high, first)
            over = np.flatnonzero(room < 0)
            words[w[over] + 1] += code[over] << (64 + room[over]).astype(np.uint64)
        raw = words.byteswap().view(np.uint8)[: int(start[-1])]
        blocks = (n + block - 1) // block
        cp = np.concatenate(([0], np.cumsum(blocks)))
        k = ptr[:-1].repeat(blocks) + (np.arange(cp[-1]) - cp[:-1].repeat(blocks)) * block
        return raw, start, at[k] - start[:-1].repeat(blocks) * 8 if len(k) else k, cp

    def decode(self, raw: np.ndarray, at: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Ids of blocks that begin at these bits and hold so many ids each, one after another."""
        b = np.concatenate((raw, np.zeros(8, np.uint8))).astype(np.uint32)
        window = (b[:-3] << np.uint32(24)) | (b[1:-2] << np.uint32(16)) | (b[2:-1] << np.uint32(8)) | b[3:]
        out = np.zeros(int(count.sum()), np.int64)
        place = np.cumsum(count) - count
        o = np.argsort(-count, kind="stable")
        at, count, place = at[o].astype(np.int64), count[o], place[o]
        live = np.searchsorted(-count, -np.arange(int(count[0]) if len(count) else 0), "left")
        mask = (1 << self.limit) - 1
        for step, k in enumerate(live.tolist()):
            p = at[:k]
            x = (window[p >> 3].astype(np.int64) >> (32 - self.limit - (p & 7))) & mask
            x = self.table[x]
            out[place[:k] + step] = x >> 5
            p += x & 31
        return out


def _ids(v: bpe.Vocabulary, name: str):
    """A row of ids (two bytes each) for each text, and at the end a row for each id that the task has seen."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in bpe._encoders:
            bpe._encoders[name] = bpe.Encoder(v)
        coder = bpe._encoders[name]
        total = np.zeros(1 << 16, np.int64)

        def flush(held):
            for (batch, _, _), (ids, count) in zip(held, coder.part([(b, o) for _, b, o in held]), strict=True):
                total[:] += np.bincount(ids, minlength=1 << 16)
                small = ids.astype(np.uint16)
                off = (np.concatenate(([0], np.cumsum(count))) * 2).astype(np.int32)
                n = batch.num_rows
                yield pa.record_batch({"doc_id": batch.column(0), "ids": pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(off), pa.py_buffer(small)]), "id": pa.nulls(n, pa.int32()), "n": pa.nulls(n, pa.int64())})

        held, size = [], 0
        for batch, b, o in steps(batches):
            held.append((batch, b, o))
            size += len(b)
            if size >= bpe.PART_BYTES:
                yield from flush(held)
                held, size = [], 0
        if held:
            yield from flush(held)
        seen = np.flatnonzero(total)
        if len(seen):
            yield pa.record_batch({"doc_id": pa.nulls(len(seen), pa.int64()), "ids": pa.nulls(len(seen), pa.binary()), "id": seen.astype(np.int32), "n": total[seen]})

    return run


def _bits(book: Codebook, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            col = whole.column(1)
            size = pa.compute.binary_length(col).to_numpy(zero_copy_only=False).astype(np.int64) // 2
            end = np.cumsum(size)
            lo = 0
            while lo < whole.num_rows:  # about a million ids at a time
                hi = max(lo + 1, int(np.searchsorted(end, (end[lo - 1] if lo else 0) + (1 << 20), "right")))
                part = whole.slice(lo, hi - lo)
                ids = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint16).astype(np.int64)
                n = size[lo:hi]
                ptr = np.concatenate(([0], np.cumsum(n)))
                raw, start, cp, cp_at = book.encode(ids, ptr, block)
                blocks = np.diff(cp_at)
                doc = np.repeat(np.arange(len(n)), blocks)
                held = np.minimum(block, n[doc] - (np.arange(len(cp)) - cp_at[doc]) * block)
                back = book.decode(raw, cp + start[doc] * 8, held)
                wrong = np.unique(np.searchsorted(ptr, np.flatnonzero(back != ids), "right") - 1)
                ok = np.ones(len(n), bool)
                ok[wrong] = False
                yield pa.record_batch(
                    {
                        "doc_id": part.column(0),
                        "n_tokens": n.astype(np.int32),
                        "bits": pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(start.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(raw))]),
                        "checkpoints": pa.ListArray.from_arrays(pa.array(cp_at.astype(np.int32)), pa.array(cp.astype(np.int64))),
                        "round_trip": pa.array(ok),
                    }
                )
                lo = hi

    return run


def encode(docs: DataFrame, path: str = bpe.VOCABULARY, limit: int = LIMIT, block: int = BLOCK) -> tuple[DataFrame, Codebook]:
    """(doc_id, n_tokens, bits, checkpoints, round_trip) of every document, and the codebook that decodes all of them."""
    ship_package(docs.sparkSession)
    v = bpe.Vocabulary(path)
    if len(v.offsets) - 1 > 1 << 16:
        raise ValueError("ids must fit two bytes")
    t = cut(docs_of(docs).mapInArrow(_ids(v, path), "doc_id long, ids binary, id int, n long"), "ids")
    counts = np.zeros(1 << 16, np.int64)
    for r in t.where("id is not null").groupBy("id").agg(F.sum("n").alias("n")).collect():
        counts[r["id"]] = r["n"]
    book = Codebook(code_lengths(counts, limit), limit)
    rows = t.where("id is null").select("doc_id", "ids")
    return rows.mapInArrow(_bits(book, block), "doc_id long, n_tokens int, bits binary, checkpoints array<long>, round_trip boolean"), book


def decode_row(book: Codebook, n_tokens: int, bits: bytes, checkpoints: list[int], block: int = BLOCK) -> list[int]:
    """The ids of one document."""
    at = np.array(checkpoints, np.int64)
    count = np.minimum(block, n_tokens - np.arange(len(at)) * block)
    return book.decode(np.frombuffer(bits, np.uint8), at, count).tolist()


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(spark.read.parquet(f"{sf_dir}/documents.parquet"))[0]
