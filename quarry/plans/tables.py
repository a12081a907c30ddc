"""Queries on the star schema and the event stream, with their SQL; those that the engine's reference behaviour doesn't have are named extensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.operators import catalogue, checks, store

QUERIES: dict = {}
SQL: dict = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


@query("SELECT l_orderkey, CAST(max(l_linenumber) - min(l_linenumber) + 1 - count(DISTINCT l_linenumber) AS BIGINT) AS gaps FROM lineitem GROUP BY 1")
def gaps_by_group(spark, d):
    return checks.integer_gaps(_t(spark, d, "lineitem"), "l_linenumber", "l_orderkey")


@query("""WITH g AS (SELECT l_orderkey, min(l_linenumber) AS a, max(l_linenumber) AS z, list(DISTINCT l_linenumber) AS s FROM lineitem GROUP BY 1)
SELECT l_orderkey, list_sort(list_filter(list_transform(generate_series(a, z), lambda x: CAST(x AS INTEGER)), lambda x: NOT list_contains(s, x))) AS missing FROM g WHERE z - a + 1 > len(s)""")
def gap_sections_missing(spark, d):
    return checks.missing_numbers(_t(spark, d, "lineitem"), "l_linenumber", "l_orderkey")


_ORD = "l_shipdate, l_partkey, l_suppkey, l_linenumber"


@query(f"""WITH a AS (SELECT l_orderkey, l_linenumber AS n, {_ORD}, lag(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY {_ORD}) AS p FROM lineitem),
b AS (SELECT l_orderkey, n, lag(n) OVER (PARTITION BY l_orderkey ORDER BY {_ORD}) AS p FROM a WHERE p IS NULL OR n <> p)
SELECT l_orderkey, count(*) FILTER (n < p OR n > p + 10) AS nonmono FROM b GROUP BY 1""")
def nonmono_by_group(spark, d):
    return checks.non_monotone(_t(spark, d, "lineitem"), "l_linenumber", ["l_shipdate", "l_partkey", "l_suppkey"], "l_orderkey")


@query("""WITH r AS (SELECT o_orderkey, o_orderdate, o_orderstatus, row_number() OVER (PARTITION BY o_orderdate ORDER BY o_orderkey DESC) AS k FROM orders)
SELECT event_id, o_orderkey AS boundary, coalesce(o_orderstatus, 'front') AS label FROM (SELECT event_id, ts - INTERVAL 20 YEAR AS at FROM events) e ASOF LEFT JOIN (SELECT * FROM r WHERE k = 1) o ON e.at >= o.o_orderdate""")
def asof_label(spark, d):
    e = _t(spark, d, "events").select("event_id", (F.col("ts") - F.expr("INTERVAL 20 YEARS")).alias("at"))
    o = _t(spark, d, "orders").select(F.col("o_orderdate").alias("at"), F.col("o_orderkey").alias("boundary"), F.col("o_orderstatus").alias("label"))
    return store.as_of(e, o, "at", "boundary", ["boundary", "label"], bucket=F.date_trunc("month", "at")).select("event_id", "boundary", F.coalesce("label", F.lit("front")).alias("label"))


@query("""SELECT o_orderkey, l_partkey, l_linenumber, o_orderpriority FROM orders JOIN lineitem ON o_orderkey = l_orderkey
WHERE coalesce(o_orderstatus <> 'F', true) AND l_returnflag = 'N' ORDER BY o_orderpriority DESC, o_orderkey, l_linenumber, l_partkey, l_suppkey""")
def catalog_join(spark, d):
    return catalogue.join(
        _t(spark, d, "orders").withColumn("is_latest", F.col("o_orderstatus") != "F").withColumnsRenamed({"o_orderkey": "page_id", "o_orderpriority": "priority"}),
        _t(spark, d, "lineitem").where("l_returnflag = 'N'").withColumnsRenamed({"l_orderkey": "page_id", "l_linenumber": "part_order"}),
        ties=["l_partkey", "l_suppkey"],
    ).select(F.col("page_id").alias("o_orderkey"), "l_partkey", F.col("part_order").alias("l_linenumber"), F.col("priority").alias("o_orderpriority"))


@query("SELECT count(*) AS n FROM (SELECT l_partkey, l_suppkey, l_returnflag FROM lineitem GROUP BY ALL HAVING count(*) > 1)")
def having_split_signature(spark, d):
    return _t(spark, d, "lineitem").groupBy("l_partkey", "l_suppkey", "l_returnflag").count().where("count > 1").agg(F.count("*").alias("n"))


@query("SELECT l_returnflag, count(DISTINCT l_orderkey) AS docs, count(*) AS c FROM lineitem GROUP BY 1 ORDER BY c DESC")
def count_distinct_by_group(spark, d):
    return _t(spark, d, "lineitem").groupBy("l_returnflag").agg(F.count_distinct("l_orderkey").alias("docs"), F.count("*").alias("c")).orderBy(F.desc("c"))


@query("""SELECT coalesce(n.id, o.id) AS id, coalesce(o.source, n.source) AS source, coalesce(n.score, o.score) AS score
FROM (SELECT doc_id AS id, source, CAST(n_chars AS DOUBLE) AS score FROM documents) o FULL JOIN (SELECT vec_id AS id, 'new' AS source, CAST(label AS DOUBLE) AS score FROM embeddings) n USING (id)""")
def upsert_keep_columns(spark, d):
    """All documents as a store, and all vectors as what comes in: a row that both have keeps its source and takes the new score."""
    old = _t(spark, d, "documents").select(F.col("doc_id").alias("id"), "source", F.col("n_chars").cast("double").alias("score"))
    new = _t(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.lit("new").alias("source"), F.col("label").cast("double").alias("score"))
    return store.upsert(old, new, "id", keep=["source"])


@query("SELECT doc_id, source FROM documents WHERE source NOT IN ('src1', 'src2')")
def delete_by_hash(spark, d):
    t = _t(spark, d, "documents").select("doc_id", "source")
    return store.delete(t, spark.createDataFrame([("src1",), ("src2",)], "source string"), "source")


@query("SELECT doc_id, lang, count(*) OVER (PARTITION BY lang) > 200 AS large FROM documents")
def group_size_flag(spark, d):
    return _t(spark, d, "documents").select("doc_id", "lang", (F.count("*").over(Window.partitionBy("lang")) > 200).alias("large"))


@query("""SELECT l_orderkey, count(*) AS chunks, count(l_shipdate) AS embedded, count(*) FILTER (l_returnflag = 'R') AS tables, CAST(min(l_quantity) AS DOUBLE) AS lo, CAST(max(l_quantity) AS DOUBLE) AS hi FROM lineitem GROUP BY 1""")
def store_counts(spark, d):
    return _t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("chunks"), F.count("l_shipdate").alias("embedded"), F.count_if(F.col("l_returnflag") == "R").alias("tables"), F.min("l_quantity").alias("lo"), F.max("l_quantity").alias("hi"))


@query("""SELECT l_orderkey, p, string_agg(DISTINCT CAST(l_partkey AS VARCHAR), ',' ORDER BY CAST(l_partkey AS VARCHAR)) AS near FROM (SELECT l_orderkey, l_partkey, unnest([l_linenumber - 1, l_linenumber, l_linenumber + 1]) AS p FROM lineitem) GROUP BY 1, 2""")
def page_neighbourhood(spark, d):
    t = _t(spark, d, "lineitem").select("l_orderkey", "l_partkey", F.explode(F.sequence(F.col("l_linenumber") - 1, F.col("l_linenumber") + 1)).alias("p"))
    return t.groupBy("l_orderkey", "p").agg(F.array_join(F.sort_array(F.collect_set(F.col("l_partkey").cast("string"))), ",").alias("near"))


@query("SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderpriority, o_orderstatus QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY n DESC, o_orderstatus) = 1")
def most_common_per_group(spark, d):
    n = _t(spark, d, "orders").groupBy("o_orderpriority", "o_orderstatus").agg(F.count("*").alias("n"))
    w = Window.partitionBy("o_orderpriority").orderBy(F.desc("n"), "o_orderstatus")
    return n.withColumn("r", F.row_number().over(w)).where("r = 1").drop("r")


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY ALL")
def events_tumbling(spark, d):
    """An extension: counts in windows of an hour."""
    return _t(spark, d, "events").groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 6).alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


@query("""WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh, event_id FROM events),
s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS k FROM e)
SELECT user_id, min(ts) AS start, count(*) AS n FROM s GROUP BY user_id, k""")
def events_session(spark, d):
    """An extension: sessions that end after half an hour without an event."""
    return _t(spark, d, "events").groupBy("user_id", F.session_window("ts", "30 minutes").alias("w")).agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("start"), "n")
