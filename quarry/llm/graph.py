"""Connected components by union-find within partitions and alternating star contraction between them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import cut, drop_cut, ship_package

_SCHEMA = "a long, b long"


class UnionFind:
    """Disjoint sets of integers with path halving; the root of a set is its least member."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        up = self.up
        up.setdefault(x, x)
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def union(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of a partition, replaced by one from each node to the root of its set; batch by batch, so that memory stays bounded."""
    for batch in batches:
        uf = UnionFind()
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            uf.union(a, b)
        nodes = [x for x in uf.up if uf.find(x) != x]
        if nodes:
            yield pa.record_batch({"a": pa.array(nodes, pa.int64()), "b": pa.array([uf.find(x) for x in nodes], pa.int64())})


#: Edges that one task may hold, 16 bytes each; more are contracted between tasks, with the same result.
LOCAL = 1_000_000


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of these edges and the least node of the component of each, by hooking and pointer jumping."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    up = np.arange(len(nodes))
    while True:
        p, q = up[x], up[y]
        apart = p != q
        if not apart.any():
            return nodes, nodes[up]
        np.minimum.at(up, np.maximum(p, q)[apart], np.minimum(p, q)[apart])
        while not np.array_equal(up, up[up]):
            up = up[up]


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [(batch.column(0).to_numpy(), batch.column(1).to_numpy()) for batch in batches if batch.num_rows]
    if parts:
        node, root = roots(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        yield pa.record_batch({"node": node, "root": root})


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60, local: int = LOCAL) -> DataFrame:
    """(node, root) for every node of an edge, root being the least node of its component; an edge of a node to itself or with a null is left out.

    What partitions leave of their own edges is finished by one task if it is at most local edges.

    Each round is a large-star and a small-star step (Kiveris et al., 2014), which halve the depth of what is left; a
    round's edges are written to the shared folder. A component that has no end after so many rounds raises.
    """
    spark = edges.sparkSession
    ship_package(spark)
    e = edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where("a <> b")
    now = cut(e.mapInArrow(_forest, _SCHEMA).distinct(), "edges")
    if now.count() <= local:
        return now.coalesce(1).mapInArrow(_whole, "node long, root long")
    mark = None
    for _ in range(rounds):
        both = now.select(F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))
        w = Window.partitionBy("a")
        large = both.withColumn("m", F.least("a", F.min("b").over(w))).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        small = down.withColumn("m", F.min("b").over(w))
        small = small.select(F.inline(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b"))))).where("a <> b").distinct()
        new = cut(small, "edges")
        drop_cut(now)
        now = new
        r = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.countDistinct("a")).first()
        if r[0] == r[2] and mark == (r[0], r[1]):
            break
        mark = (r[0], r[1])
    else:
        raise RuntimeError("components: no end after the rounds allowed")
    return now.select(F.inline(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("root")), F.struct(F.col("b").alias("node"), F.col("b").alias("root"))))).distinct()


def sorted_edges(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same edges with the lesser end first."""
    return np.minimum(x, y), np.maximum(x, y)
