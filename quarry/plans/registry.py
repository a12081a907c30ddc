"""All queries of the engine proper, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.plans import corpus, more, reports, tables

QUERIES: dict = {**corpus.QUERIES, **tables.QUERIES, **more.QUERIES, **reports.QUERIES}
SQL: dict = {**corpus.SQL, **tables.SQL, **more.SQL, **reports.SQL}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark text as a query: BM25 ranking, and how soon a document that contains it comes."""
    return corpus.reachability(spark, sf_dir)
