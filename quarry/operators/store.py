"""Snapshots of a chunk store: upsert, delete, resume, and the as-of join; a snapshot is written anew and never changed in place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def upsert(existing: DataFrame, incoming: DataFrame, key: str, keep: list[str]) -> DataFrame:
    """existing with the rows of incoming by key; of a row that both have, the columns keep stay as they were."""
    e = existing.select(F.col(key), F.struct(*[c for c in existing.columns if c != key]).alias("__e"))
    i = incoming.select(F.col(key), F.struct(*[c for c in existing.columns if c != key]).alias("__i"))
    j = e.join(i, key, "full_outer")
    both = F.col("__e").isNotNull() & F.col("__i").isNotNull()
    pick = lambda c: F.when(F.col("__i").isNull() | (both & F.lit(c in keep)), F.col(f"__e.{c}")).otherwise(F.col(f"__i.{c}")).alias(c)
    return j.select(*[F.col(key) if c == key else pick(c) for c in existing.columns])


def delete(existing: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    return existing.join(gone.select(key).distinct(), key, "left_anti")


def todo(items: DataFrame, done: DataFrame, *key: str) -> DataFrame:
    """Items that a cache of finished work doesn't have."""
    return items.join(done.select(*key).distinct(), list(key), "left_anti")


def as_of(rows: DataFrame, bounds: DataFrame, at: str, order: str, take: list[str], by: list[str] | None = None, bucket: Column | None = None) -> DataFrame:
    """rows with the columns take of the last bound at or before their place; of bounds at one place the last by order.

    The two are sorted together once and the last bound is carried forward: no row is compared with each bound. Where
    there is no key to spread by, bucket (an expression of at that doesn't decrease) cuts the order into parts: each part carries forward within
    itself, and the last bound of the parts before comes from a table of one row a part.
    """
    by = by or []
    b = F.lit(0) if bucket is None else bucket
    take = list(dict.fromkeys(take))
    marks = bounds.select(*by, at, F.struct(F.col(at).alias("__at"), F.col(order).alias("__o"), *take).alias("__m"), F.lit(0).alias("__s"), F.lit(None).cast(_row_type(rows)).alias("__r")).withColumn("__b", b)
    data = rows.select(*by, at, F.lit(None).cast(marks.schema["__m"].dataType).alias("__m"), F.lit(1).alias("__s"), F.struct(*rows.columns).alias("__r")).withColumn("__b", b)
    w = Window.partitionBy(*by, "__b").orderBy(at, "__s", F.col("__m.__o")).rowsBetween(Window.unboundedPreceding, 0)
    u = marks.unionByName(data).withColumn("__last", F.last("__m", ignorenulls=True).over(w)).where("__s = 1")
    parts = marks.groupBy(*by, "__b").agg(F.max(F.struct("__m.__at", "__m.__o", "__m")).alias("x")).select(*by, "__b", F.col("x.__m").alias("__m"), F.lit(0).alias("__s"))
    need = u.select(*by, "__b").distinct().select(*by, "__b", F.lit(None).cast(marks.schema["__m"].dataType).alias("__m"), F.lit(-1).alias("__s"))
    before = Window.partitionBy(*by).orderBy("__b", "__s").rowsBetween(Window.unboundedPreceding, 0)
    carried = need.unionByName(parts).withColumn("__before", F.last("__m", ignorenulls=True).over(before)).where("__s = -1").select(*by, "__b", "__before")
    u = u.join(carried, [*by, "__b"], "left")
    got = F.coalesce("__last", "__before")
    return u.select("__r.*", *[got[c].alias(c) for c in take])


def _row_type(df: DataFrame):
    """The type of a struct of all columns of df."""
    return df.select(F.struct(*df.columns).alias("r")).schema["r"].dataType
