"""Sinks: exports of chunks and tables, and append-only caches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.text import head3
from quarry.operators.store import todo
from quarry.session import file_of
from quarry.sources.schemas import CHUNKS

EXPORT = ["chunk_index", "page_start", "section", "article_no", "article_title", "chunk_type", "token_count", "table_id", "is_boilerplate", "content"]


def chunks_jsonl(chunks: DataFrame, path: str) -> None:
    chunks.select(*EXPORT).write.mode("overwrite").json(path)


def dry_run(chunks: DataFrame, path: str) -> DataFrame:
    """Writes the chunks with the first three numbers of each vector, and gives the one-row summary."""
    chunks.withColumn("embedding", head3(F.col("embedding"))).write.mode("overwrite").json(path)
    return summary(chunks)


def summary(chunks: DataFrame) -> DataFrame:
    """One row: chunks, least, greatest and mean tokens, those over 600, and chunks by type."""
    n = chunks.groupBy("chunk_type").agg(F.count("*").alias("n"), F.min("token_count").alias("lo"), F.max("token_count").alias("hi"), F.sum("token_count").alias("s"), F.count_if(F.col("token_count") > 600).alias("over"))
    return n.agg(F.sum("n").alias("chunks"), F.min("lo").alias("min"), F.max("hi").alias("max"), F.bround(F.sum("s") / F.sum("n"), 1).alias("avg"), F.sum("over").alias("over_600"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("chunk_type", "n")))).alias("types"))


def tables(parts: DataFrame, path: str) -> None:
    """Markdown of large tables by table_id."""
    parts.select("table_id", "markdown").where("table_id is not null").write.mode("overwrite").parquet(path)


def table_files(parts: DataFrame, folder: str) -> None:
    """Markdown of large tables as one text file a table: folder/table_id=.../ holds its lines."""
    parts.where("table_id is not null").select("table_id", F.col("markdown").alias("value")).repartition("table_id").write.mode("overwrite").partitionBy("table_id").text(folder)


def init_store(spark: SparkSession, path: str, skip: bool = False) -> bool:
    """An empty store of chunks at path where there is none, unless skip is set; tells whether it was made."""
    fs, p = file_of(spark, path)
    if skip or fs.exists(p):
        return False
    spark.createDataFrame([], CHUNKS).write.parquet(path)
    return True


def append_new(rows: DataFrame, done: DataFrame, path: str, *key: str) -> DataFrame:
    """Appends the rows whose key a cache doesn't have, and gives them."""
    new = todo(rows, done, *key)
    new.write.mode("append").parquet(path)
    return new
