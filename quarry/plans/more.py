"""Further queries: text scalars, taxonomies, question sets, promotion, sets and summaries, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.functions import text as X
from quarry.operators import checks, questions, retrieval, segment, terms
from quarry.plans import corpus

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


@query("""SELECT doc_id, len(regexp_extract_all(text, '  +')) AS double_spaces, regexp_replace(text, '\\s+', '', 'g') AS dense, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS squeezed,
length(regexp_replace(text, '[^0-9]', '', 'g')) AS digits, regexp_matches(text, '[·.]{6,}') AS contents_mark, text[1:3] AS head FROM documents""")
def text_scalars(spark, d):
    t = F.col("text")
    return _t(spark, d, "documents").select("doc_id", X.double_spaces(t).cast("long").alias("double_spaces"), X.dense(t).alias("dense"), X.squeeze(t).alias("squeezed"), X.hangul_digits(t).cast("long").alias("digits"), t.rlike(segment.TOC_MARK).alias("contents_mark"), F.substring(t, 1, 3).alias("head"))


@query("SELECT source AS doc, doc_id % 10 AS page, lang AS source, text AS markdown FROM documents QUALIFY row_number() OVER (PARTITION BY source, doc_id % 10 ORDER BY len(regexp_extract_all(text, '  +')), CASE lang WHEN 'fr' THEN 1 WHEN 'de' THEN 2 ELSE 3 END, lang, doc_id) = 1")
def best_table_per_page(spark, d):
    c = _t(spark, d, "documents").withColumn("__id", F.col("doc_id"))
    c = c.select(F.col("source").alias("doc"), (F.col("doc_id") % 10).alias("page"), F.col("lang").alias("source"), F.col("text").alias("markdown"), "__id")
    # one candidate a source and page
    c = c.withColumn("__r", F.row_number().over(Window.partitionBy("doc", "page", "source").orderBy(F.regexp_count("markdown", F.lit("  +")), "__id"))).where("__r = 1").drop("__r", "__id")
    return segment.best_table(c, ("fr", "de"))


_CHUNKS = "SELECT l_suppkey AS doc_hash, CASE WHEN l_returnflag = 'A' THEN NULL ELSE l_returnflag END AS section, nullif(l_linenumber, 1) AS article_no, l_linestatus = 'F' AS is_table, l_shipdate, l_orderkey, l_partkey, l_linenumber FROM lineitem"


def _chunks(spark, d) -> DataFrame:
    t = _t(spark, d, "lineitem")
    return t.select(F.col("l_suppkey").alias("doc_hash"), F.when(F.col("l_returnflag") != "A", F.col("l_returnflag")).alias("section"), F.nullif("l_linenumber", F.lit(1)).alias("article_no"), (F.col("l_linestatus") == "F").alias("is_table"), "l_shipdate", "l_orderkey", "l_partkey", "l_linenumber")


@query(f"SELECT doc_hash, count(*) AS n, round(avg(CAST(article_no IS NOT NULL AS DOUBLE)), 6) AS restored FROM ({_CHUNKS}) WHERE section IS NOT NULL AND NOT is_table GROUP BY doc_hash")
def article_restore_rate(spark, d):
    return checks.restore_rate(_chunks(spark, d), "doc_hash")


@query(f"""WITH c AS (SELECT *, row_number() OVER w = 1 OR section IS DISTINCT FROM lag(section) OVER w AS first FROM ({_CHUNKS}) WINDOW w AS (PARTITION BY doc_hash ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey))
SELECT CASE WHEN first THEN 'first' ELSE 'other' END AS kind, count(*) AS count FROM c WHERE article_no IS NULL AND NOT is_table AND section IS NOT NULL GROUP BY 1""")
def unlabelled_taxonomy(spark, d):
    return checks.unlabelled(_chunks(spark, d), ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"])


@query("""WITH s AS (SELECT source AS doc_hash, lang AS section, quality AS article_no, embedding, TIMESTAMP '2024-01-01' + to_days(CAST(doc_id AS INTEGER)) AS seen FROM documents LEFT JOIN embeddings ON vec_id = doc_id LEFT JOIN labels USING (doc_id))
SELECT 'OK' AS state, 'chunks ' || count(*) AS message FROM s UNION ALL SELECT CASE WHEN count(embedding) = count(*) THEN 'OK' ELSE 'WARN' END, 'embedded ' || count(embedding) FROM s
UNION ALL SELECT CASE WHEN max(len(embedding)) = 64 THEN 'OK' ELSE 'FAIL' END, 'dimension ' || max(len(embedding)) FROM s UNION ALL SELECT CASE WHEN count(*) = 0 THEN 'OK' ELSE 'WARN' END, 'split clauses ' || count(*) FROM (SELECT 1 FROM s GROUP BY doc_hash, section, article_no HAVING count(*) > 1)
UNION ALL SELECT 'INFO', 'last ' || strftime(max(seen), '%Y-%m-%d %H:%M:%S') FROM s""")
def deployment_readiness(spark, d):
    """Documents as the chunks of a store, with the vectors and labels that they have."""
    e = _t(spark, d, "documents").join(_t(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding"), "doc_id", "left").join(_t(spark, d, "labels"), "doc_id", "left")
    at = F.timestamp_add("DAY", F.col("doc_id").cast("int"), F.lit("2024-01-01").cast("timestamp"))
    return checks.readiness(e.select("embedding", F.col("source").alias("doc_hash"), F.col("lang").alias("section"), F.col("quality").alias("article_no"), at.alias("ingested_at")), 64)


@query("""WITH k AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[A-Za-z]{6,}')) AS term FROM benchmark), d AS (SELECT regexp_replace(text, '\\s+', '', 'g') AS c FROM documents)
SELECT term, count(*) AS df FROM k JOIN d ON contains(c, term) WHERE term <> '' GROUP BY term""")
def keyword_substring_frequency(spark, d):
    k = _t(spark, d, "benchmark").select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]{6,}"), 0)).alias("term"))
    return questions.keyword_frequency(k, _t(spark, d, "documents").select(F.col("text").alias("content")))


@query(f"""WITH r AS ({corpus._bm25_sql(False)}), g AS ({corpus._GOLD}) SELECT item_id AS qid, min_by(doc_id, rank) AS chunk_id FROM r WHERE rank <= 20 AND NOT EXISTS (SELECT 1 FROM g WHERE g.item_id = r.item_id AND g.doc_id = r.doc_id) GROUP BY 1""")
def hard_negative(spark, d):
    r = corpus.bm25_topk(spark, d).withColumnsRenamed({"item_id": "qid", "doc_id": "chunk_id"})
    return questions.hard_negatives(r, corpus.gold_expand(spark, d).withColumnsRenamed({"item_id": "qid", "doc_id": "chunk_id"}))


@query(f"SELECT qid, parent_id, CAST(place AS INTEGER) AS rank FROM (SELECT qid, id % 50 AS parent_id, row_number() OVER (PARTITION BY qid ORDER BY min(rank), id % 50) AS place FROM ({corpus._TOP}) GROUP BY qid, id % 50) WHERE place <= 40")
def small_to_big(spark, d):
    r = corpus._ranked(spark, d).select("qid", F.col("id").alias("child_id"), "rank")
    p = _t(spark, d, "embeddings").select(F.col("vec_id").alias("child_id"), (F.col("vec_id") % 50).alias("parent_id"))
    return retrieval.promote(r, p)


@query("""WITH q AS (SELECT text AS q, coalesce(lag(text) OVER (PARTITION BY conv_id ORDER BY turn), '') AS before FROM conversations)
SELECT coalesce(CASE WHEN length(q) < 10 OR length(q) > 65 THEN 'length' WHEN contains(q, 'nicht') THEN 'oos_guard' WHEN NOT contains(regexp_replace(before, '\\s+', '', 'g'), regexp_replace(q, '\\s+', '', 'g')) THEN 'span_anchor' WHEN length(before) >= 200 THEN 'leak' END, 'kept') AS reason, count(*) AS n FROM q GROUP BY 1""")
def question_rejects(spark, d):
    """Every turn as a question about the turn before it."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    q = _t(spark, d, "conversations").withColumn("before", F.coalesce(F.lag("text").over(w), F.lit("")))
    why = questions.reject(F.col("text"), F.col("text"), F.col("before"), F.when(F.length("before") >= 200, 14).otherwise(0), F.contains("text", F.lit("nicht")))
    return q.select(F.coalesce(why, F.lit("kept")).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


@query("SELECT doc_id FROM labels WHERE quality = 0 UNION SELECT doc_id FROM labels WHERE toxic = 1")
def labels_union(spark, d):
    t = _t(spark, d, "labels")
    return t.where("quality = 0").select("doc_id").union(t.where("toxic = 1").select("doc_id")).distinct()


@query(f"SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY min(seq)) AS INTEGER) AS ord, line FROM ({corpus._LINES}) GROUP BY doc_id, line")
def ordered_distinct_lines(spark, d):
    n = segment.first_occurrences(segment.lines(_t(spark, d, "documents")), "doc_id", "seq", "line")
    return n.select("doc_id", F.row_number().over(Window.partitionBy("doc_id").orderBy("seq")).alias("ord"), "line")


@query("SELECT source, doc_id, n_chars FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) <= 3")
def worst_per_source(spark, d):
    return retrieval.top(_t(spark, d, "documents").select("source", "doc_id", "n_chars"), "source", "n_chars", "doc_id", 3).drop("rank")


@query("SELECT status, count(*) AS documents, CAST(sum(n) AS BIGINT) AS chunks FROM (SELECT CASE WHEN length(text) < 200 THEN 'SKIPPED' ELSE 'OK' END AS status, length(text) // 500 AS n FROM documents) GROUP BY 1")
def run_summary(spark, d):
    from quarry.operators.catalogue import run_summary as summary

    return summary(_t(spark, d, "documents").select(F.when(F.length("text") < 200, "SKIPPED").otherwise("OK").alias("status"), F.floor(F.length("text") / 500).cast("long").alias("chunks")))


@query(f"""WITH t AS (SELECT DISTINCT term FROM (SELECT unnest({corpus._TOK}) AS term FROM benchmark) WHERE length(term) >= 2), g AS (SELECT DISTINCT term, substr('  ' || term || ' ', CAST(i AS BIGINT), 3) AS g FROM t, unnest(generate_series(1, length(term) + 1)) AS s(i)), n AS (SELECT term, count(*) AS n FROM g GROUP BY 1),
p AS (SELECT a.term AS word, b.term, count(*) AS c FROM g a JOIN g b USING (g) GROUP BY ALL)
SELECT word, p.term, round(c / (x.n + y.n - c), 6) AS similarity FROM p JOIN n x ON x.term = word JOIN n y ON y.term = p.term WHERE c / (x.n + y.n - c) >= 0.6""")
def trigram_terms(spark, d):
    """An extension: terms with like trigrams."""
    t = terms.distinct_terms(_t(spark, d, "benchmark"))
    return terms.trigram_similar(t, t, 0.6).withColumn("similarity", F.round("similarity", 6))
