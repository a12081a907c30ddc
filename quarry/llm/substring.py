"""Repeated passages: difference-cover anchors, verified and extended to the passages they lie in.

A passage counts as repeated if a run of MIN_WORDS words of it occurs at two places at least, in one document or in
several. Windows of MIN_WORDS - PERIOD + 1 words are hashed only at the places whose number modulo PERIOD is in a
difference cover: for any two places i and j some d < PERIOD has both i + d and j + d in the cover, so any two equal
runs of MIN_WORDS words share a window that both hash. Places within reach of a shared anchor, and no others, are then
extended: their whole run of MIN_WORDS words is hashed and compared, and equal runs that overlap are merged.

Copies of a whole document are settled by one hash of all its words, so that they add nothing to the second comparison.

Defined results: of equal runs the one in the least (doc_id, place) is the first and stays, whatever the order of rows;
texts of fewer than MIN_WORDS words (null and empty ones too) have no repeated passage; rows without a doc_id are left
alone; rows that repeat a doc_id are one document, so that they don't repeat each other. An empty table gives no rows. A text of any
length is read whole, and other columns, whatever their names, are left as they are. A passage is removed only where both its anchor and its
whole run have equal 64-bit hashes, which are different sums over the words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import buffers, docs_of, mix, numbered, signed, sorted_runs, steps, window_hashes, words
from quarry.session import cut, ship_package, small_side

MIN_WORDS = 50
#: A perfect difference set: every residue modulo 31 is a difference of two of its members.
PERIOD, COVER = 31, (1, 5, 11, 24, 25, 27)
_WHOLE = np.uint64(0xA0761D6478BD642F)


def in_cover(n: int, period: int = PERIOD, cover: tuple[int, ...] = COVER) -> np.ndarray:
    """Of each place below n, whether its windows are hashed."""
    mask = np.zeros(period, bool)
    mask[list(cover)] = True
    return mask[np.arange(n) % period]


def _anchors(least: int):
    size = least - PERIOD + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, b, o in steps(batches):
            h, _, _, ptr = words(b, o)
            n = np.diff(ptr)
            ids = batch.column(0).to_numpy()
            long_docs = np.flatnonzero(n >= least)
            if not len(long_docs):
                continue
            doc = np.repeat(np.arange(len(n)), n)
            w = window_hashes(h, size)
            place = np.arange(len(w)) - ptr[doc[: len(w)]]
            d = doc[: len(w)]
            mask = np.zeros(PERIOD, bool)
            mask[list(COVER)] = True
            at = np.flatnonzero(mask[place % PERIOD] & (place + size <= n[d]) & (n[d] >= least))
            # one more row a document: place -1, the hash of all its words
            whole = np.add.reduceat(np.append(mix(h + np.uint64(1) + (np.arange(len(h)) - ptr[doc]).astype(np.uint64) * _WHOLE), np.uint64(0)), ptr[:-1])[long_docs]
            yield pa.record_batch({"hash": signed(np.concatenate((w[at], mix(whole ^ _WHOLE)))), "doc": np.concatenate((ids[d[at]], ids[long_docs])), "place": np.concatenate((place[at], np.full(len(long_docs), -1))).astype(np.int32), "twin": np.zeros(len(at) + len(long_docs), bool)})

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose hash is at two places at least (or whose document has a copy: twin), and whether theirs is the least; batches are in the order of hash, doc, place. One row is held from batch to batch, however often a hash occurs."""
    held = None  # the last row so far: hash, doc, place, and whether it waits for another of its hash
    for batch in batches:
        if batch.num_rows == 0:
            continue
        h, d, p = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("hash", "doc", "place"))
        twin = batch.column(batch.schema.get_field_index("twin")).to_numpy(zero_copy_only=False)
        waits = False
        if held is not None:
            h, d, p = np.append(held[0], h), np.append(held[1], d), np.append(held[2], p)
            twin = np.append(False, twin)
            waits = held[4]
        fresh = np.ones(len(h), bool)
        fresh[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1]) | (p[1:] != p[:-1])
        h, d, p, twin = h[fresh], d[fresh], p[fresh], twin[fresh]
        start = np.ones(len(h), bool)
        start[1:] = h[1:] != h[:-1]
        if held is not None:
            start[0] = held[3]
        more = np.zeros(len(h), bool)  # another row of the hash follows
        more[:-1] = ~start[1:]
        emit = ~start | more | twin
        if held is not None:
            emit[0] = waits and more[0]
        held = (h[-1:], d[-1:], p[-1:], bool(start[-1]), bool(start[-1] and not emit[-1]) if len(h) > 1 or held is None else waits and not emit[-1])
        if emit.any():
            yield pa.record_batch({"doc": d[emit], "place": p[emit].astype(np.int32), "first": pa.array(start[emit])})


_SHARED = "doc long, place int, first boolean"


def _runs(least: int):
    """Hashes of the runs of least words that contain a shared anchor."""
    size = least - PERIOD + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, b, o in steps(batches):
            h, _, _, ptr = words(b, o)
            n = np.diff(ptr)
            ids = batch.column(0).to_numpy()
            anchors = batch.column(2)
            if isinstance(anchors, pa.ChunkedArray):
                anchors = anchors.combine_chunks()
            a = anchors.flatten().to_numpy().astype(np.int64)
            d = np.repeat(np.arange(len(n)), np.diff(anchors.offsets.to_numpy()))
            ok = a + size <= n[d]
            a, d = a[ok], d[ok]
            edge = np.zeros(len(h) + 1, np.int64)
            np.add.at(edge, ptr[d] + np.maximum(0, a - (least - size)), 1)
            np.add.at(edge, ptr[d] + a + 1, -1)
            inside = np.cumsum(edge[:-1]) > 0
            doc = np.repeat(np.arange(len(n)), n)
            place = np.arange(len(h)) - ptr[doc]
            at = np.flatnonzero(inside & (place + least <= n[doc]))
            if len(at):
                w = window_hashes(h, least)
                twin = batch.column(3).to_numpy(zero_copy_only=False)
                yield pa.record_batch({"hash": signed(w[at]), "doc": ids[doc[at]], "place": place[at].astype(np.int32), "twin": pa.array(twin[doc[at]])})

    return run


def _spans(least: int):
    """Places in the order of doc, first, place, as merged spans of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in sorted_runs(batches, "doc"):
            d, f, p = t.column("doc").to_numpy(), t.column("first").to_numpy(zero_copy_only=False), t.column("place").to_numpy()
            e = p + t.column("size").to_numpy()
            new = np.ones(len(d), bool)
            new[1:] = (d[1:] != d[:-1]) | (f[1:] != f[:-1])
            # spans of one length are in the order of their ends too, and a whole copy is the only one of its document
            new[1:] |= p[1:] > e[:-1]
            at = np.flatnonzero(new)
            last = np.append(at[1:], len(d)) - 1
            yield pa.record_batch({"doc_id": d[at], "start_word": p[at], "end_word": e[last], "removed": pa.array(~f[at])})

    return run


def repeated_spans(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """(doc_id, start_word, end_word, removed): the passages of each document that lie in repeated runs of least words or more.

    removed marks the passages whose runs occur earlier; the others are first occurrences. Word numbers begin at 0 and
    end_word is past the end.
    """
    if least < PERIOD + 1:
        raise ValueError(f"least must be over {PERIOD}")
    spark = docs.sparkSession
    ship_package(spark)
    d = docs_of(docs)

    def shared(rows: DataFrame) -> DataFrame:
        return rows.repartition(F.col("hash")).sortWithinPartitions("hash", "doc", "place").mapInArrow(_shared, _SHARED)

    hits = cut(shared(d.mapInArrow(_anchors(least), "hash long, doc long, place int, twin boolean")), "anchors")
    copies = hits.where("place < 0 and not first").select(F.col("doc").alias("copy")).distinct()
    copies = cut(copies, "copies")
    places = hits.where("place >= 0").join(small_side(copies), F.col("doc") == F.col("copy"), "left_anti")
    twins = hits.where("place < 0 and first").select("doc", F.lit(True).alias("twin")).distinct()
    lists = places.groupBy("doc").agg(F.sort_array(F.collect_set("place")).alias("anchors")).join(twins, "doc", "left")
    lists = cut(lists.select("doc", "anchors", F.coalesce("twin", F.lit(False)).alias("twin")), "lists")
    near = d.join(small_side(lists.select(F.col("doc").alias("doc_id"))), "doc_id", "left_semi")
    near = near.join(lists.withColumnRenamed("doc", "doc_id"), "doc_id").select("doc_id", "text", "anchors", "twin")
    runs = shared(near.mapInArrow(_runs(least), "hash long, doc long, place int, twin boolean")).select("doc", "first", "place", F.lit(least).alias("size"))
    sizes = d.join(small_side(copies), F.col("doc_id") == F.col("copy"), "left_semi").mapInArrow(_lengths, "doc long, size int")
    whole = sizes.groupBy("doc").agg(F.max("size").alias("size")).select("doc", F.lit(False).alias("first"), F.lit(0).alias("place"), "size")
    spans = runs.unionByName(whole).repartition(F.col("doc")).sortWithinPartitions("doc", "first", "place")
    return spans.mapInArrow(_spans(least), "doc_id long, start_word int, end_word int, removed boolean")


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, b, o in steps(batches):
        ptr = words(b, o)[3]
        yield pa.record_batch({"doc": batch.column(0), "size": np.diff(ptr).astype(np.int32)})


def cut_text(b: np.ndarray, o: np.ndarray, lists: list, ptr: np.ndarray, s: np.ndarray, e: np.ndarray) -> list[str]:
    """The texts without the words of the spans given for each: a list of (start word, end word) pairs in order. A span goes from its first word's first byte to its last word's last."""
    out = []
    for i, spans in enumerate(lists):
        lo, parts = o[i], []
        n = ptr[i + 1] - ptr[i]
        for x, y in spans or ():
            y = min(y, n)
            if x >= y:
                continue
            parts.append(b[lo : max(lo, s[ptr[i] + x])])
            lo = max(lo, e[ptr[i] + y - 1])
        parts.append(b[lo : o[i + 1]])
        out.append(b"".join(p.tobytes() for p in parts).decode("utf-8", "replace"))
    return out


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Last two columns: text and the starts and ends of its spans, by turns; the text comes back shortened."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        k = batch.schema.get_field_index("__q_text")
        b, o = buffers(batch.column(k))
        _, s, e, ptr = words(b, o)
        flat = batch.column(batch.schema.get_field_index("__q_spans")).to_pylist()
        texts = cut_text(b, o, [sorted((x["start_word"], x["end_word"]) for x in f) if f else None for f in flat], ptr, s, e)
        yield pa.record_batch([*batch.columns[:k], pa.array(texts, pa.string())], schema=pa.schema([*list(batch.schema)[:k], pa.field("__q_text", pa.string())]))


def remove_repeats(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """docs with the passages cut out that repeated_spans() marks as removed, and n_chars, where there is one, set to the new length.

    A document of which no word is left goes; all others stay, with their other columns as they were.
    """
    d, at = numbered(docs)
    text = at["text"]
    spans = repeated_spans(docs, least).where("removed").groupBy(F.col("doc_id").alias("__q_id")).agg(F.collect_list(F.struct("start_word", "end_word")).alias("__q_spans"))
    spans = cut(spans, "spans")
    key = F.col(at["doc_id"]).try_cast("long") == F.col("__q_id")
    ids = small_side(spans.select("__q_id"))
    clean = d.join(ids, key, "left_anti")
    hit = d.join(ids, key, "left_semi").join(spans, key)
    hit = hit.select(*d.columns, F.col(text).cast("string").alias("__q_text"), "__q_spans")
    schema = hit.drop("__q_spans").schema
    hit = hit.mapInArrow(_remove, schema).where(F.col("__q_text").rlike(r"[\p{L}\p{N}]"))
    new = hit.withColumn(text, F.col("__q_text"))
    if "n_chars" in at:
        new = new.withColumn(at["n_chars"], F.length(text).cast(d.schema[at["n_chars"]].dataType))
    return clean.unionByName(new.drop("__q_text")).toDF(*docs.columns)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"))
