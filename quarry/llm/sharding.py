"""Sharding by balanced label propagation: linked documents move towards their neighbours' shards under quotas.

Any two documents are linked that share a line of LINE_WORDS words or more, with the number of such lines as weight. The links
are not made one by one: documents are counted by line and shard, and a document's weight towards a shard is the sum of its
lines' counts there, less itself, which is the same at a cost in proportion to the lines. The
documents are first dealt out by size, largest first, to and fro over the shards (in groups of about DEAL documents that a
hash of doc_id makes). In each round a document would move to the shard with the greatest weight of its neighbours
(ties: the least shard), if that is more than in its own; a hash of doc_id and round lets half of the documents move, so that
two neighbours don't just change places. How much may move from one shard to another is set by quotas in
bytes: as much as goes the opposite way, and a share of the room left below the capacity of (1 + SLACK) times the mean.
Within a quota the greatest gains go first (by quarters of their logarithm to base 2, then in the order of BUCKETS parts by a hash of doc_id,
and within these by gain; ties: the least doc_id). As documents are not divisible, what would go is
added up, and quotas into a shard shrink until none is above capacity, so no round makes a shard exceed it. A round's labels
are written to the shared folder; the rounds end early if nothing would move in two of them.

Defined results: a null or empty text weighs one byte and has no links; rows without a doc_id are left out; rows that
repeat a doc_id are one document, as large as the largest, with the lines of all; an empty table gives no rows. A text of any length
is read whole, and a document larger than a shard's capacity stays where it is dealt. Other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.common import docs_of, mix, signed, steps, words
from quarry.session import cut, drop_cut, ship_package

SHARDS = 16
ROUNDS = 12
SLACK = 0.05
DEAL = 100_000
LINE_WORDS = 6
#: Parts by a hash of doc_id of the moves of like gain between two shards.
BUCKETS = 64


def _lines(least: int):
    """A row for each distinct long line of a text, and one with the hash 0 for its size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, b, o in steps(batches):
            h, s, _, _ = words(b, o)
            ids = batch.column(0).to_numpy()
            begin = np.unique(np.concatenate((np.flatnonzero(b == 10) + 1, o[:-1])))
            begin = begin[begin < len(b)]
            sizes = np.maximum(np.diff(o), 1)
            doc = hashes = np.zeros(0, np.int64)
            if len(begin) and len(h):
                ptr = np.searchsorted(s, np.append(begin, len(b)))
                n = np.diff(ptr)
                place = (np.arange(len(h)) - np.repeat(ptr[:-1], n)).astype(np.uint64)
                x = np.append(mix(h + place * np.uint64(0x9E3779B97F4A7C15)), np.uint64(0))
                some = np.flatnonzero(n >= least)
                if len(some):
                    edge = np.stack((ptr[some], ptr[some + 1]), 1).reshape(-1)
                    hashes = signed(mix(np.add.reduceat(x, edge)[::2] + n[some].astype(np.uint64)))
                    doc = ids[np.searchsorted(o, begin[some], "right") - 1]
            yield pa.record_batch({"hash": np.concatenate((hashes, np.zeros(len(sizes), np.int64))), "doc": np.concatenate((doc, ids)), "size": np.concatenate((np.zeros(len(doc), np.int64), sizes))})

    return run


def members(docs: DataFrame, least: int = LINE_WORDS) -> tuple[DataFrame, DataFrame]:
    """(doc, size) of every document, and (hash, doc) of the lines that two documents or more share, both written."""
    ship_package(docs.sparkSession)
    rows = docs_of(docs).mapInArrow(_lines(least), "hash long, doc long, size long")
    rows = cut(rows, "lines")
    sizes = cut(rows.where("hash = 0 and size > 0").groupBy("doc").agg(F.max("size").alias("size")), "sizes")
    lines = rows.where("hash <> 0").select("hash", "doc")
    shared = lines.groupBy("hash").agg(F.count("*").alias("n"), F.min("doc").alias("lo"), F.max("doc").alias("hi")).where("lo < hi").select("hash")
    lines = cut(lines.join(shared, "hash", "left_semi").distinct(), "shared")
    drop_cut(rows)
    return sizes, lines


def links(docs: DataFrame, least: int = LINE_WORDS) -> tuple[DataFrame, DataFrame]:
    """(doc, size) of every document, and of all links (a, b, w) those between neighbours in the order of doc_id along each line: a small sample to measure cuts by."""
    sizes, lines = members(docs, least)
    along = lines.withColumn("b", F.lead("doc").over(Window.partitionBy("hash").orderBy("doc")))
    edges = along.where("b is not null").groupBy(F.col("doc").alias("a"), "b").agg(F.count("*").alias("w"))
    return sizes, cut(edges, "links")


def weights(lines: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc, own, size, shard, w): the weight of each document's links to each shard that has any of its lines, its own shard included."""
    there = lines.join(labels.select("doc", "shard"), "doc").groupBy("hash", "shard").agg(F.count("*").alias("n"))
    near = lines.join(there, "hash").groupBy("doc", "shard").agg(F.sum("n").alias("w"), F.count("*").alias("lines"))
    own = F.col("shard") == F.col("own")  # each of its lines counts the document itself there
    return near.join(labels.select("doc", F.col("shard").alias("own"), "size"), "doc").select("doc", "own", "size", "shard", (F.col("w") - F.when(own, F.col("lines")).otherwise(0)).alias("w"))


def deal(sizes: DataFrame, shards: int) -> DataFrame:
    """(doc, size, shard): the first shards, even in size."""
    groups = max(1, round(sizes.count() / DEAL))
    w = Window.partitionBy(F.pmod(F.xxhash64("doc", F.lit(1)), F.lit(groups))).orderBy(F.desc("size"), "doc")
    place = F.row_number().over(w) - 1
    lap, k = F.floor(place / shards), F.pmod(place, F.lit(shards))
    return sizes.select("doc", "size", F.when(lap % 2 == 0, k).otherwise(shards - 1 - k).cast("int").alias("shard"))


def _quotas(size: dict[int, int], asked: dict[tuple[int, int], int], capacity: float, shards: int, largest: dict[tuple[int, int], int], taken) -> dict[tuple[int, int], float]:
    """Bytes that may move from a shard to another: a bounded table of shards by shards. taken: what really moves under given quotas; largest: the largest document that moves, by shards."""
    room = {j: max(0.0, capacity - size.get(j, 0)) for j in range(shards)}
    into = {j: sum(v for (_, t), v in asked.items() if t == j) for j in range(shards)}
    share = {(i, j): room[j] * v / into[j] for (i, j), v in asked.items()}
    quota = {(i, j): min(v, asked.get((j, i), 0) + share[i, j]) for (i, j), v in asked.items()}
    real = taken(quota)
    # a quota that shrinks below what moved takes that much or up to one document less, which bounds what goes and comes
    most = {k: float(real.get(k, 0)) for k in quota}
    least = dict(most)
    for _ in range(200):
        fine = True
        for j in range(shards):
            come = sum(v for (_, t), v in most.items() if t == j)
            free = room[j] + sum(v for (f, _), v in least.items() if f == j)
            if come > free:
                fine = False
                for i in range(shards):
                    if most.get((i, j)):
                        quota[i, j] = most[i, j] = most[i, j] * free / come * 0.999
                        least[i, j] = max(0.0, min(least[i, j], most[i, j] - largest[i, j]))
        if fine:
            return quota
    return share  # no exchange at all: what comes in fits the room even if nothing leaves


def in_order(moves: DataFrame) -> DataFrame:
    """moves (doc, own, to, size, gain) with sum, the bytes up to and with each in the order of its shard pair.

    Sums are added up in two steps: over buckets of like gains and of a hash of doc_id, of which a pair of shards has a few
    thousand whatever the table's size, and then within each bucket, so that no task has all the moves between two shards.
    """
    level = F.floor(F.log2("gain") * 4).cast("int").alias("level")
    m = moves.select("doc", "own", "to", "size", "gain", level, F.pmod(F.xxhash64("doc", F.lit(-1)), F.lit(BUCKETS)).cast("int").alias("bucket"))
    key = ["own", "to", "level", "bucket"]
    before = Window.partitionBy("own", "to").orderBy(F.desc("level"), "bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = m.groupBy(*key).agg(F.sum("size").alias("s")).select(*key, F.coalesce(F.sum("s").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy(*key).orderBy(F.desc("gain"), "doc").rowsBetween(Window.unboundedPreceding, 0)
    return m.withColumn("part", F.sum("size").over(within)).join(sums, key).select("doc", "own", "to", "size", (F.col("before") + F.col("part")).alias("sum"))


def shard(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS, slack: float = SLACK, least: int = LINE_WORDS) -> DataFrame:
    """(doc_id, shard, size) of every document."""
    spark = docs.sparkSession
    sizes, lines = members(docs, least)
    dealt = cut(deal(sizes, shards), "dealt")
    linked = lines.select("doc").distinct()
    moving = cut(dealt.join(linked, "doc", "left_semi"), "labels")
    still = dealt.join(linked, "doc", "left_anti")
    fixed = {r["shard"]: r["s"] for r in still.groupBy("shard").agg(F.sum("size").alias("s")).collect()}
    whole = sizes.agg(F.sum("size")).first()[0] or 0
    capacity = whole / shards * (1 + slack)
    idle = 0
    for t in range(rounds):
        size = dict(fixed)
        for r in moving.groupBy("shard").agg(F.sum("size").alias("s")).collect():
            size[r["shard"]] = size.get(r["shard"], 0) + r["s"]
        best = weights(lines, moving).groupBy("doc", "own", "size").agg(F.max_by("shard", F.struct("w", -F.col("shard"))).alias("to"), F.max("w").alias("top"), F.max(F.when(F.col("shard") == F.col("own"), F.col("w")).otherwise(0)).alias("here"))
        moves = best.where("to <> own and top > here").where(F.pmod(F.xxhash64("doc", F.lit(t)), F.lit(2)) == 0).select("doc", "own", "to", "size", (F.col("top") - F.col("here")).alias("gain"))
        moves = cut(in_order(moves), "moves")

        def table(quota: dict[tuple[int, int], float]) -> DataFrame:
            return F.broadcast(spark.createDataFrame([(i, j, float(v)) for (i, j), v in quota.items()], "own int, to int, quota double"))

        def taken(quota: dict[tuple[int, int], float], moves: DataFrame = moves, table=table) -> dict[tuple[int, int], int]:
            return {(r["own"], r["to"]): r["s"] for r in moves.join(table(quota), ["own", "to"]).where("sum <= quota").groupBy("own", "to").agg(F.max("sum").alias("s")).collect()}

        table_of = moves.groupBy("own", "to").agg(F.max("sum").alias("s"), F.max("size").alias("m")).collect()
        asked = {(r["own"], r["to"]): r["s"] for r in table_of}
        if not asked:
            drop_cut(moves)
            idle += 1
            if idle == 2:
                break
            continue
        idle = 0
        quota = _quotas(size, asked, capacity, shards, {(r["own"], r["to"]): r["m"] for r in table_of}, taken)
        go = moves.join(table(quota), ["own", "to"]).where("sum <= quota").select("doc", "to")
        new = cut(moving.join(go, "doc", "left").select("doc", "size", F.coalesce("to", "shard").alias("shard")), "labels")
        drop_cut(moving)
        drop_cut(moves)
        moving = new
    return moving.unionByName(still).select(F.col("doc").alias("doc_id"), "shard", "size")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(spark.read.parquet(f"{sf_dir}/documents.parquet"))
