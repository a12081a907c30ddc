"""Near-duplicate groups: SuperMinHash signatures, banding, verification by exact similarity and union-find grouping.

A document is the set of hashes of its runs of SHINGLE words (one run of all its words if it has fewer). SuperMinHash
(Ertl, 2017) gives each element one random permutation of the slots: at level j the element offers j + r, r uniform in
[0, 1), to the slot at place j of its permutation. Slots keep the least offer, and as an offer of a later level can't be
less, a document is done at the first level after which no slot is empty. The levels of all documents of a batch run
side by side here, with the Fisher-Yates state of the documents that still have empty slots alone.

Defined results: documents without words (null, empty, punctuation) and rows without a doc_id belong to no group; rows
that repeat a doc_id are one document, the row with the least text (common.once() says which, whatever the order of rows); a table
without rows gives no groups. Ties: a group's document that stays is the one with the least doc_id. A text of any length is
taken whole. Other columns, whatever their names, are left as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.common import docs_of, mix, numbered, once, release, signed, steps, words
from quarry.llm.graph import components
from quarry.session import cut, drop_cut, ship_package, small_side

SHINGLE = 3
SLOTS = 128
#: 42 bands of 3 of the slots: a pair at the threshold shares one with a chance of 0.996.
BAND_ROWS = 3
THRESHOLD = 0.5
#: Candidates whose share of equal slots is this far below the threshold (4.5 standard deviations) are not verified.
LOOSE = 0.2
_EMPTY = np.uint32(0xFFFFFFFF)
_GOLD = 0x9E3779B97F4A7C15


def shingles(h: np.ndarray, ptr: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of size words of each text, and where each text's begin; a shorter text with words has one run."""
    n = np.diff(ptr)
    count = np.where(n == 0, 0, np.maximum(1, n - size + 1))
    out = np.zeros(int(count.sum()), np.uint64)
    at = np.concatenate(([0], np.cumsum(count)))
    doc = np.repeat(np.arange(len(n)), count)
    start = np.arange(len(out)) - at[doc] + ptr[doc]
    end = ptr[doc + 1]
    acc = np.zeros(len(out), np.uint64)
    for j in range(size):
        p = start + j
        ok = p < end
        x = h[np.minimum(p, max(len(h) - 1, 0))] if len(h) else acc
        acc = mix(acc * np.uint64(0xD6E8FEB86659FD93) + np.where(ok, x, np.uint64(0)))
    out[:] = acc
    return out, at


def superminhash(h: np.ndarray, ptr: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """Signatures (texts by slots) of the element hashes h of texts that begin at ptr: level in the upper 7 bits, r in the lower 25. A text without elements has all slots empty."""
    n = len(ptr) - 1
    sig = np.full(n * slots, _EMPTY, np.uint32)
    doc = np.repeat(np.arange(n), np.diff(ptr))
    perm = None
    k0 = None
    for j in range(slots):
        if len(doc) == 0:
            break
        x = mix(h + np.uint64((j + 1) * _GOLD & (2**64 - 1)))
        k = (((x & np.uint64(0xFFFFFFFF)) * np.uint64(slots - j)) >> np.uint64(32)).astype(np.int64) + j
        if j == 0:
            slot = k0 = k
        else:
            if perm is None:  # the state that level 0 left
                perm = np.tile(np.arange(slots, dtype=np.uint8), (len(doc), 1))
                rows = np.arange(len(doc))
                perm[rows, k0] = 0
                perm[rows, 0] = k0
            rows = np.arange(len(doc))
            slot = perm[rows, k].astype(np.int64)
            perm[rows, k] = perm[rows, j]
            perm[rows, j] = slot
        np.minimum.at(sig, doc * slots + slot, (np.uint32(j << 25) | (x >> np.uint64(39)).astype(np.uint32)))
        full = (sig.reshape(n, slots) != _EMPTY).all(1)
        left = ~full[doc]
        if not left.all():
            doc, h, k0 = doc[left], h[left], k0[left]
            if perm is not None:
                perm = perm[left]
    return sig.reshape(n, slots)


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of slots in which two rows of signatures agree: an estimate of the Jaccard similarity."""
    return (a == b).mean(1)


def _sets(batch: pa.RecordBatch, b: np.ndarray, o: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text in order, one after another, and where each text's begin, with the end."""
    h, _, _, ptr = words(b, o)
    g, at = shingles(h, ptr, size)
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
    order = np.lexsort((g, doc))
    g, doc = g[order], doc[order]
    once_ = np.ones(len(g), bool)
    once_[1:] = (g[1:] != g[:-1]) | (doc[1:] != doc[:-1])
    g, doc = g[once_], doc[once_]
    return g, np.searchsorted(doc, np.arange(len(at)))


def _rows(x: np.ndarray) -> pa.Array:
    """Each row's bytes."""
    width = x.itemsize * x.shape[1]
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(x), [None, pa.py_buffer(np.ascontiguousarray(x))]).cast(pa.binary())


def _signatures(size: int, slots: int, rows: int):
    """Two hashes of each set, a byte of each slot, and the hashes of the bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, b, o in steps(batches, most=1 << 19):
            g, at = _sets(batch, b, o, size)
            some = np.diff(at) > 0
            sig = superminhash(g, at, slots)[some]
            if not len(sig):
                continue
            first = at[:-1][some]
            whole = np.stack([mix(np.add.reduceat(mix(g + np.uint64(k)), first)) for k in (_GOLD, _GOLD >> 7)], 1)
            wide = sig[:, : slots // rows * rows].reshape(len(sig), slots // rows, rows).astype(np.uint64)
            acc = np.broadcast_to(np.arange(slots // rows, dtype=np.uint64), wide.shape[:2]).copy()
            for r in range(rows):
                acc = mix(acc * np.uint64(_GOLD) + wide[:, :, r])
            ids = batch.column(0).filter(pa.array(some))
            short = (mix(sig.astype(np.uint64)) & np.uint64(255)).astype(np.uint8)
            yield pa.record_batch({"doc_id": ids, "whole": _rows(whole), "sig": _rows(short), "bands": pa.ListArray.from_arrays(np.arange(len(sig) + 1, dtype=np.int32) * acc.shape[1], signed(acc.reshape(-1)))})

    return run


def _like(slots: int, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, slots) for i in (2, 3))
            ok = pa.array(estimate(x, y) >= least)
            yield pa.record_batch({"a": batch.column(0).filter(ok), "b": batch.column(1).filter(ok)})

    return run


def _shingle_bytes(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, b, o in steps(batches, most=1 << 19):
            g, at = _sets(batch, b, o, size)
            yield pa.record_batch({"doc_id": batch.column(0), "shingles": pa.array([g[i:j].tobytes() for i, j in zip(at[:-1], at[1:], strict=True)], pa.binary())})

    return run


def _alike(threshold: float):
    """Pairs whose sets have that similarity at least: rows (a, part, b, set) in order, where b is null in the row of a's own set, which comes first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, mine = None, np.zeros(0, np.uint64)
        for batch in batches:
            found = []
            for a, b, x in zip(*(batch.column(batch.schema.get_field_index(c)) for c in ("a", "b", "shingles")), strict=True):
                g = np.frombuffer(x.as_buffer(), np.uint64)
                if not b.is_valid:
                    now, mine = a.as_py(), g.copy()
                    continue
                if a.as_py() != now:
                    raise RuntimeError("minhash: a pair without its first set")
                n = len(mine) + len(g)
                if min(len(mine), len(g)) < threshold * max(len(mine), len(g)):
                    continue
                at = np.minimum(np.searchsorted(mine, g), len(mine) - 1)
                common = int((mine[at] == g).sum())
                if common >= threshold * (n - common):
                    found.append((now, b.as_py()))
            if found:
                yield pa.record_batch({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})
        release()

    return run


#: Most sets, by expectation, that one task holds against the same set.
PART = 2000


def near_groups(docs: DataFrame, shingle: int = SHINGLE, slots: int = SLOTS, band_rows: int = BAND_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, group_id, kept) of every document in a group of two or more; group_id is the least doc_id of the group, which is the one kept.

    Two documents are linked if they share the hash of a band of slots and the Jaccard similarity of their sets of shingles
    is at least threshold; signatures only rule out pairs far below it. Of documents with the same set, one stands for all. In each bucket all are held against its least document; where
    a bucket is not one group after that, all pairs across its groups are held against each other, so no pair that
    shares a bucket goes untested unless it is in one group already. Sets are made again from the texts of the documents in
    pairs that signatures don't rule out; of a pair, only one set is shuffled, to where the other is.
    """
    ship_package(docs.sparkSession)
    d = docs_of(once(docs))
    t = cut(d.mapInArrow(_signatures(shingle, slots, band_rows), "doc_id long, whole binary, sig binary, bands array<long>"), "sig")
    first = t.groupBy("whole").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")).where("n > 1").select("whole", "rep")
    same = cut(t.select("whole", "doc_id").join(first, "whole").where("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b")), "same")
    sigs = cut(t.join(small_side(same.select(F.col("b").alias("doc_id"))), "doc_id", "left_anti").select("doc_id", "sig", "bands"), "reps")
    drop_cut(t)
    bands = sigs.select("doc_id", F.explode("bands").alias("band"))
    star = bands.withColumn("lead", F.min("doc_id").over(Window.partitionBy("band"))).where("doc_id <> lead")
    star = cut(star.select("band", F.col("lead").alias("a"), F.col("doc_id").alias("b")), "star")

    def verified(pairs: DataFrame) -> DataFrame:
        s = sigs.select("doc_id", "sig")
        p = pairs.join(s.select(F.col("doc_id").alias("a"), F.col("sig").alias("sa")), "a").join(s.select(F.col("doc_id").alias("b"), F.col("sig").alias("sb")), "b")
        like = cut(p.select("a", "b", "sa", "sb").mapInArrow(_like(slots, threshold - LOOSE), "a long, b long"), "like")
        ids = small_side(cut(like.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "ids"))
        sets = cut(d.join(ids, "doc_id", "left_semi").mapInArrow(_shingle_bytes(shingle), "doc_id long, shingles binary"), "sets")
        # a document in very many pairs is dealt into parts, each with its set
        parts = like.groupBy("a").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
        whole = sets.join(parts.withColumnRenamed("a", "doc_id"), "doc_id").select(F.col("doc_id").alias("a"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(None).cast("long").alias("b"), "shingles")
        # only where there is more than one part is the number of parts joined to the pairs
        many = small_side(cut(parts.where("parts > 1"), "parts"))
        dealt = like.join(many, "a", "left").select("a", F.coalesce(F.pmod(F.xxhash64("b"), F.col("parts")), F.lit(0)).cast("int").alias("part"), "b")
        rows = whole.unionByName(dealt.join(sets.withColumnRenamed("doc_id", "b"), "b"))
        return rows.repartition("a", "part").sortWithinPartitions("a", "part", "b").mapInArrow(_alike(threshold), "a long, b long")

    one = cut(verified(star.select("a", "b").distinct()), "pairs")
    # buckets that are not yet one group
    open_bands = cut(star.join(one, ["a", "b"], "left_anti").select("band").distinct(), "open")
    links = one.select("a", "b")
    if not open_bands.isEmpty():
        comp = components(links)
        there = star.join(open_bands, "band", "left_semi")
        members = there.select("band", F.explode(F.array("a", "b")).alias("doc_id")).distinct()
        members = members.join(comp.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("band", "doc_id", F.coalesce("root", "doc_id").alias("root"))
        members = cut(members, "members")
        x, y = members.select("band", F.col("doc_id").alias("a"), F.col("root").alias("ra")), members.select("band", F.col("doc_id").alias("b"), F.col("root").alias("rb"))
        cross = x.join(y, "band").where("ra <> rb and a < b").select("a", "b").distinct()
        two = verified(cross.join(star.select("a", "b").distinct(), ["a", "b"], "left_anti"))
        links = links.union(cut(two, "pairs").select("a", "b"))
    g = components(same.union(links))
    return g.select(F.col("node").alias("doc_id"), F.col("root").alias("group_id"), (F.col("node") == F.col("root")).alias("kept"))


def deduplicate(docs: DataFrame, **how) -> DataFrame:
    """docs without the documents of near_groups() that are not kept; of rows that repeat a doc_id the one that common.once() chooses stays, and rows without a doc_id stay as they are."""
    docs = once(docs)
    t, at = numbered(docs)
    gone = near_groups(docs, **how).where(~F.col("kept")).select(F.col("doc_id").alias("__q_gone"))
    gone = small_side(cut(gone, "gone"))
    return t.join(gone, F.col(at["doc_id"]).try_cast("long") == F.col("__q_gone"), "left_anti").toDF(*docs.columns)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
