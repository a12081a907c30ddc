"""Extractors as functions of a page's content: each gives tables in Markdown, or fails on its own page alone."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.pyfuncs import rows_to_markdown, table_markdown
from quarry.session import ship_package

#: From the content and number of a page: tables as Markdown, or as rows of cells, or nothing.
Extractor = Callable[[bytes, int], "list | str | None"]


def _markdown(got) -> str | None:
    parts = [got] if isinstance(got, str) else [x if isinstance(x, str) else rows_to_markdown(x) for x in got or []]
    return "\n\n".join(p for p in parts if p and p.strip()) or None


def tables(pages: DataFrame, name: str, *flavours: Extractor, cap: int | None = None, answers: bool = False) -> DataFrame:
    """(doc, page, source, markdown, error): what an extractor finds on pages (doc, page, content).

    Of several flavours the first that gives a table counts, and one that fails is passed over; error is that of the last
    to fail where none gave a table. cap: no more pages of each document than that, its first ones (null: all). answers: the
    function gives a model's answer, in which a table is looked for.
    """
    ship_package(pages.sparkSession)
    p = pages.select("doc", F.col("page").cast("int").alias("page"), "content")
    if cap is not None:
        p = p.withColumn("__r", F.row_number().over(Window.partitionBy("doc").orderBy("page"))).where(F.col("__r") <= cap).drop("__r")

    def one(content: bytes, page: int) -> tuple[str | None, str | None]:
        error = None
        for f in flavours:
            try:
                got = f(content, page)
                md = table_markdown(got) if answers else _markdown(got)
            except Exception as e:  # whatever an extractor raises is of this page alone
                error = f"{type(e).__name__}: {e}"
                continue
            if md:
                return md, None
        return None, error

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [one(c.as_py(), n.as_py()) for n, c in zip(batch.column(1), batch.column(2), strict=True)]
            yield pa.record_batch({"doc": batch.column(0), "page": batch.column(1), "source": pa.array([name] * len(got), pa.string()), "markdown": pa.array([g[0] for g in got], pa.string()), "error": pa.array([g[1] for g in got], pa.string())})

    return p.mapInArrow(run, f"doc {p.schema['doc'].dataType.simpleString()}, page int, source string, markdown string, error string")


def found(candidates: DataFrame) -> DataFrame:
    """(doc, page, source, markdown) of the pages that gave a table."""
    return candidates.where("markdown is not null").select("doc", "page", "source", "markdown")


def fetched(spark, paths: DataFrame, read: Callable[[str], bytes]) -> DataFrame:
    """(path, content, error): objects by path, each read on its own: one that can't be read is a row with its error, and the others come all the same."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            content, error = [], []
            for path in batch.column(0).to_pylist():
                try:
                    content.append(read(path))
                    error.append(None)
                except Exception as e:  # of this object alone
                    content.append(None)
                    error.append(f"{type(e).__name__}: {e}")
            yield pa.record_batch({"path": batch.column(0), "content": pa.array(content, pa.binary()), "error": pa.array(error, pa.string())})

    return paths.select("path").mapInArrow(run, "path string, content binary, error string")


def whole_files(parts: DataFrame) -> DataFrame:
    """(page_id, parts, content, sha): files of one part or several (page_id, name, content, sha256), in the order of their names. A file of one part is held against its recorded digest: equal, different or missing; several make a list of contents whose digest isn't known (parts)."""
    g = parts.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("name", "content"))).alias("p"), F.max("sha256").alias("recorded"))
    one = F.size("p") == 1
    digest = F.sha2(F.get("p", F.lit(0))["content"], 256)
    sha = F.when(~one, "parts").when(F.coalesce("recorded", F.lit("")) == "", "missing").when(digest == F.col("recorded"), "equal").otherwise("different")
    return g.select("page_id", F.size("p").alias("parts"), F.transform("p", lambda x: x["content"]).alias("content"), sha.alias("sha"))
