"""Continuous ingest: a file source whose batches go into the store once each, then terms are rebuilt."""

from __future__ import annotations

import contextlib
import signal
import threading
import time
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.store import todo
from quarry.operators.terms import rebuild
from quarry.session import file_of


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at path, or None where there is none yet."""
    fs, p = file_of(spark, path)
    return spark.read.parquet(path) if fs.exists(p) and any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(p)) else None


def poll(spark: SparkSession, source: str, schema: str, store: str, checkpoint: str, prepare: Callable[[DataFrame], DataFrame] = lambda d: d, doc: str = "doc_hash", key: str = "chunk_id", once: bool = True, every: str = "7 days"):
    """Reads new Parquet files of source and appends the prepared rows of documents (doc) that the store doesn't have, all rows of a document, but one of those with the same key. Once: all there is now, then the query ends.

    Each batch is a folder of the store named by its number, written over if the batch is run again after a failure: so a half-written batch leaves
    nothing behind, and no batch is there twice. prepare keeps documents whole; the rows of a document come in one batch.
    """

    def add(batch: DataFrame, number: int) -> None:
        rows = prepare(batch).dropDuplicates([key])
        done = _read(batch.sparkSession, store)
        if done is not None:
            done = done.where(F.col("batch") != number) if "batch" in done.columns else done
            rows = todo(rows, done, doc)
        rows.write.mode("overwrite").parquet(f"{store}/batch={number}")

    w = spark.readStream.schema(schema).parquet(source).writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w.trigger(processingTime=every)).start()


@contextlib.contextmanager
def lock(spark: SparkSession, path: str) -> Iterator[bool]:
    """True if this job holds the lock, a file that one job alone can create; False, without waiting, while another holds it."""
    fs, p = file_of(spark, path)
    try:
        fs.create(p, False).close()
        mine = True
    except Exception as e:
        if "exist" not in str(e).lower():
            raise
        mine = False
    try:
        yield mine
    finally:
        if mine:
            fs.delete(p, False)


def rebuild_terms(store: DataFrame, path: str, text: str = "content") -> dict:
    """Appends the store's new terms to the table at path, unless another job does so now, and tells how many there were."""
    spark = store.sparkSession
    with lock(spark, path.rstrip("/") + ".lock") as mine:
        if not mine:
            return {"extracted": 0, "inserted": 0, "total": 0, "skipped": True}
        fresh, stats = rebuild(store, _read(spark, path), text)
        told = stats.first().asDict()
        fresh.write.mode("append").parquet(path)
        return {**told, "skipped": False}


def cycle(ingest: Callable[[], bool], rebuild_: Callable[[], object]) -> str:
    """One turn: ingest, then the terms, which stay as they are if ingest fails or tells that it did."""
    try:
        good = ingest()
    except Exception as e:  # a turn that fails must not end those after it
        return f"failed: {e}"
    if not good:
        return "failed"
    rebuild_()
    return "done"


def run_forever(turn: Callable[[], object], seconds: float = 604_800, on_start: bool = True, stop: threading.Event | None = None) -> int:
    """Turns, one each so many seconds, until a signal to end or stop; a turn under way is finished. Gives the number of turns."""
    stop = stop or threading.Event()
    if threading.current_thread() is threading.main_thread():
        for s in (signal.SIGTERM, signal.SIGINT):
            signal.signal(s, lambda *_: stop.set())
    turns, due = 0, time.monotonic() + (0 if on_start else seconds)
    while not stop.wait(max(0.0, due - time.monotonic())):
        turn()
        turns, due = turns + 1, time.monotonic() + seconds
    return turns


def late_counts(events: DataFrame, window: str = "1 hour", delay: str = "2 hours") -> DataFrame:
    """An extension: counts by window and type of a stream of events (ts, event_type); events later than delay are left out."""
    return events.withWatermark("ts", delay).groupBy(F.window("ts", window).alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")
