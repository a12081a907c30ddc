"""The document catalogue: which files to read, in which order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join(files: DataFrame, parts: DataFrame, limit: int | None = None, ties: list[str] | None = None) -> DataFrame:
    """Latest files (a null is_latest counts as latest) with their parts, greatest priority first (nulls before all), then by page_id and part_order."""
    j = files.where(F.coalesce("is_latest", F.lit(True))).join(parts, "page_id")
    j = j.orderBy(F.desc_nulls_first("priority"), "page_id", "part_order", *(ties or []))
    return j if limit is None else j.limit(limit)


def pending(catalogue: DataFrame, store: DataFrame, digest: str = "sha256", doc: str = "doc_hash") -> DataFrame:
    """Catalogue rows whose content isn't in the store; rows without a digest are always pending. This comes before any content is read."""
    return catalogue.join(store.select(F.col(doc).alias(digest)).distinct(), digest, "left_anti")


def run_summary(status: DataFrame) -> DataFrame:
    """Documents and chunks by status."""
    return status.groupBy("status").agg(F.count("*").alias("documents"), F.sum("chunks").alias("chunks"))
