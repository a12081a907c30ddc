"""Queries on documents, conversations, pages and vectors, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.functions import text as X
from quarry.operators import checks, classify, contain, evaluation, retrieval, segment, terms
from quarry.session import cut


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


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


_TOK = "list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda x: x <> '')"
#: Words that stand for the classes of clauses in prose that isn't Korean.
RULES = [("exclusion", ["not", "nicht", "sans"]), ("duty", ["must", "muss"]), ("claim", ["with", "mit", "avec"]), ("definition", ["the", "der", "les"]), ("coverage", ["que", "con"])]
_CASE = "CASE " + " ".join(f"WHEN contains(text, '{w}') THEN '{n}'" for n, ws in RULES for w in ws) + " ELSE 'general' END"


@query("SELECT doc_id, substr(sha256(concat_ws(':', coalesce(source, ''), CAST(doc_id AS VARCHAR), text)), 1, 24) AS chunk_id FROM documents")
def chunk_ids_sha(spark, d):
    return _t(spark, d, "documents").select("doc_id", X.chunk_key(F.col("source"), F.col("doc_id"), F.col("text")).alias("chunk_id"))


@query("""SELECT lang, count(*) AS n, CAST(min(t) AS INTEGER) AS lo, CAST(max(t) AS INTEGER) AS hi, round(avg(t), 6) AS mean, median(t) AS middle, count(*) FILTER (t > 600) AS over_600
FROM (SELECT lang, length(text) * 6 // 10 AS t FROM documents) GROUP BY lang""")
def token_estimate_stats(spark, d):
    t = _t(spark, d, "documents").select("lang", X.tokens(F.col("text")).alias("t"))
    return t.groupBy("lang").agg(F.count("*").alias("n"), F.min("t").alias("lo"), F.max("t").alias("hi"), F.round(F.avg("t"), 6).alias("mean"), F.median("t").alias("middle"), F.count_if(F.col("t") > 600).alias("over_600"))


@query("""SELECT page_id, CASE WHEN regexp_matches(url, '/en/') THEN 'policy_terms' WHEN regexp_matches(url, '/(de|fr)/') THEN 'schedule' ELSE 'product_summary' END AS doc_type FROM pages""")
def doc_type_by_source_pattern(spark, d):
    return _t(spark, d, "pages").select("page_id", classify.document_type(F.col("url"), [("policy_terms", "/en/"), ("schedule", "/(de|fr)/")]).alias("doc_type"))


@query(f"SELECT doc_id, {_CASE} AS chunk_type FROM documents")
def keyword_class_first_match(spark, d):
    return _t(spark, d, "documents").select("doc_id", classify.plain_class(F.col("text"), RULES).alias("chunk_type"))


@query(f"WITH c AS (SELECT {_CASE} AS t, count(*) AS n FROM documents GROUP BY 1) SELECT max(n) AS top, CAST(sum(n) AS BIGINT) AS n, round(max(n) / sum(n), 6) AS share, max(n) / sum(n) > 0.95 AS skewed FROM c")
def keyword_class_skew(spark, d):
    return checks.skewed(keyword_class_first_match(spark, d))


@query(f"WITH p AS (SELECT doc_id, CAST({_CASE} = 'definition' AS INTEGER) AS a FROM documents) SELECT count(*) AS n, round(avg(CAST(a = quality AS DOUBLE)), 6) AS agreement FROM p JOIN labels USING (doc_id)")
def classifier_agreement(spark, d):
    p = keyword_class_first_match(spark, d).select("doc_id", (F.col("chunk_type") == "definition").cast("int").alias("a"))
    return evaluation.agreement(p, _t(spark, d, "labels"), "doc_id", "a", "quality")


_LINES = "SELECT doc_id, i AS seq, l[i] AS line FROM (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(13))), lambda x: x <> '') AS l FROM documents), unnest(generate_series(1, len(l))) AS t(i)"


@query(f"SELECT doc_id, CAST(seq AS INTEGER) AS seq, line FROM ({_LINES})")
def line_split_order(spark, d):
    return segment.lines(_t(spark, d, "documents"))


@query("SELECT doc_id, list_aggregate(list_filter(string_split(text, chr(10)), lambda x: NOT regexp_matches(x, '^.{0,20}$')), 'string_agg', chr(10)) AS body FROM documents")
def footer_line_drop(spark, d):
    r = _t(spark, d, "documents").select("doc_id", segment.without_lines(F.col("text"), "^.{0,20}$").alias("body"))
    return r.select("doc_id", F.nullif("body", F.lit("")).alias("body"))


def _pack_sql(before: bool, size: int) -> str:
    t = "length(l[i + 1]) * 6 // 10"
    over = f"(s > 0 AND s + {t} > {size})" if before else f"s >= {size}"
    return f"""WITH RECURSIVE a AS (SELECT doc_id, list(line ORDER BY seq) AS l FROM ({_LINES}) GROUP BY doc_id),
r AS (SELECT doc_id, l, 1 AS i, 0 AS g, length(l[1]) * 6 // 10 AS s FROM a
UNION ALL SELECT doc_id, l, i + 1, CASE WHEN {over} THEN g + 1 ELSE g END, CASE WHEN {over} THEN {t} ELSE s + {t} END FROM r WHERE i < len(l))
SELECT doc_id, CAST(g AS INTEGER) AS part, CAST(min(i) AS INTEGER) AS first_seq, count(*) AS n, string_agg(l[i], chr(10) ORDER BY i) AS text FROM r GROUP BY doc_id, g"""


@query(_pack_sql(False, 500))
def greedy_pack_after(spark, d):
    return segment.packed(segment.lines(_t(spark, d, "documents")), "doc_id", False, 500).drop("run")


@query(_pack_sql(True, 450))
def greedy_pack_before(spark, d):
    return segment.packed(segment.lines(_t(spark, d, "documents")), "doc_id", True, 450).drop("run")


@query(f"""WITH f AS (SELECT doc_id, seq, length(line) < 200 AS f, row_number() OVER (PARTITION BY doc_id ORDER BY seq) AS r FROM ({_LINES})),
g AS (SELECT doc_id, seq, r - row_number() OVER (PARTITION BY doc_id ORDER BY seq) AS i FROM f WHERE f)
SELECT doc_id, CAST(min(seq) AS INTEGER) AS first, CAST(max(seq) AS INTEGER) AS last, count(*) AS n FROM g GROUP BY doc_id, i HAVING count(*) >= 3""")
def citation_runs(spark, d):
    return segment.runs(segment.lines(_t(spark, d, "documents")), F.length("line") < 200, "doc_id", "seq", 3)


@query(f"""WITH f AS (SELECT doc_id, seq, length(line) < 60 AS f, row_number() OVER (PARTITION BY doc_id ORDER BY seq) AS r, line FROM ({_LINES})),
g AS (SELECT doc_id, seq, line, r - row_number() OVER (PARTITION BY doc_id ORDER BY seq) AS i FROM f WHERE f)
SELECT doc_id, CAST(min(seq) AS INTEGER) AS first, count(*) AS n, string_agg(line, chr(10) ORDER BY seq) AS text FROM g GROUP BY doc_id, i HAVING count(*) >= 2""")
def title_only_runs(spark, d):
    n = segment.lines(_t(spark, d, "documents"))
    r = segment.runs(n, F.length("line") < 60, "doc_id", "seq", 2)
    j = n.join(r, "doc_id").where(F.col("seq").between(F.col("first"), F.col("last")))
    return j.groupBy("doc_id", "first", "n").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "line"))), lambda x: x["line"]), "\n").alias("text"))


_BAR = "SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: contains(x, ' | ')) AS l FROM documents"


@query(f"""SELECT doc_id, CAST(w AS INTEGER) AS part, CAST(w * 2 + 1 AS INTEGER) AS row_start, CAST(least(w * 2 + 2, len(l) - 1) AS INTEGER) AS row_end,
l[1] || chr(10) || array_to_string(l[w * 2 + 2 : w * 2 + 3], chr(10)) AS text
FROM ({_BAR}), unnest(generate_series(0, (len(l) - 2) // 2)) AS t(w) WHERE len(l) - 1 > 2""")
def row_window_split(spark, d):
    b = _t(spark, d, "documents").select("doc_id", F.filter(F.split("text", "\n"), lambda x: F.contains(x, F.lit(" | "))).alias("l")).where(F.size("l") > 3)
    md = b.select("doc_id", F.array_join(F.transform("l", lambda x: F.concat(F.lit("|"), x)), "\n").alias("md"))
    r = segment.row_windows(md, "doc_id", "md", 2)
    return r.withColumn("text", F.regexp_replace("text", r"(?m)^\|", ""))


@query("""WITH l AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: contains(x, '|')) AS l FROM documents)
SELECT doc_id, list_max(n) - list_min(n) > 1 AS ragged FROM (SELECT doc_id, list_transform(l, lambda x: length(x) - length(replace(x, '|', ''))) AS n FROM l WHERE len(l) >= 2)""")
def ragged_tables(spark, d):
    return _t(spark, d, "documents").select("doc_id", checks.ragged(F.col("text")).alias("ragged")).where("ragged is not null")


@query("""WITH k AS (SELECT doc_id, substr(regexp_replace(text, '[\\s\\d.,]+', '', 'g'), 1, 300) AS k FROM documents)
SELECT doc_id, k <> '' AND doc_id <> min(doc_id) OVER (PARTITION BY k) AS is_boilerplate, CASE WHEN k <> '' AND doc_id <> min(doc_id) OVER (PARTITION BY k) THEN CAST(min(doc_id) OVER (PARTITION BY k) AS VARCHAR) END AS canonical_id FROM k""")
def boilerplate_mark(spark, d):
    c = _t(spark, d, "documents").select("doc_id", F.col("doc_id").cast("string").alias("chunk_id"), F.substring(F.regexp_replace("text", r"(?U)[\s\d.,]+", ""), 1, 300).alias("k"))
    return segment.boilerplate(c, F.col("k"), ["doc_id"]).select("doc_id", "is_boilerplate", "canonical_id")


@query(f"SELECT doc_id, CAST(min(seq) AS INTEGER) AS seq, line, count(*) AS n FROM ({_LINES}) GROUP BY doc_id, line HAVING count(*) > 1")
def first_occurrence_dedup(spark, d):
    n = segment.lines(_t(spark, d, "documents")).withColumn("member", F.array("seq"))
    r = segment.first_occurrences(n, "doc_id", "seq", "line", members="member")
    return r.where(F.size("member") > 1).select("doc_id", "seq", "line", F.size("member").cast("long").alias("n"))


@query("SELECT substr(regexp_replace(text, '\\s+', '', 'g'), 1, 400) AS key, min(doc_id) AS representative, count(*) AS n, list_sort(list(doc_id)) AS members FROM documents GROUP BY 1")
def dup_groups_rep(spark, d):
    t = _t(spark, d, "documents").select("doc_id", F.substring(X.dense(F.col("text")), 1, 400).alias("key"))
    return t.groupBy("key").agg(F.min("doc_id").alias("representative"), F.count("*").alias("n"), F.sort_array(F.collect_list("doc_id")).alias("members"))


@query("""WITH r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY sha256(CAST(doc_id AS VARCHAR)), doc_id) AS round, count(*) OVER (PARTITION BY source) AS size FROM documents)
SELECT doc_id, source, CAST(round AS INTEGER) AS round, CAST(row_number() OVER (ORDER BY round, size DESC, source) AS INTEGER) AS place FROM r ORDER BY place LIMIT 100""")
def stratified_round_robin(spark, d):
    w = Window.partitionBy("source").orderBy(F.sha2(F.col("doc_id").cast("string"), 256), "doc_id")
    r = _t(spark, d, "documents").select("doc_id", "source", F.row_number().over(w).alias("round"), F.count("*").over(Window.partitionBy("source")).alias("size"))
    r = r.orderBy("round", F.desc("size"), "source").limit(100)
    return r.select("doc_id", "source", "round", F.row_number().over(Window.orderBy("round", F.desc("size"), "source")).alias("place"))


@query("""WITH c AS (SELECT doc_id, text, length(text) * 6 // 10 AS t, source FROM documents), i AS (SELECT doc_id, unnest([CASE WHEN regexp_replace(text, '\\s', '', 'g') = '' THEN 'blank' END, CASE WHEN t < 10 THEN 'tiny' END, CASE WHEN source IS NULL OR source = '' THEN 'missing' END, CASE WHEN t > 600 THEN 'long' END]) AS issue FROM c)
SELECT CAST(doc_id AS VARCHAR) AS chunk_id, issue FROM i WHERE issue IS NOT NULL""")
def validate_reasons(spark, d):
    c = _t(spark, d, "documents").select(F.col("doc_id").cast("string").alias("chunk_id"), F.col("text").alias("content"), X.tokens(F.col("text")).alias("token_count"), F.lit("general").alias("chunk_type"), "source")
    return checks.validate(c, "source")[1]


@query(f"SELECT term FROM (SELECT DISTINCT unnest({_TOK}) AS term FROM documents) WHERE length(term) >= 2")
def distinct_terms(spark, d):
    return terms.distinct_terms(_t(spark, d, "documents"))


@query(f"SELECT term FROM (SELECT DISTINCT unnest({_TOK}) AS term FROM benchmark) WHERE length(term) >= 2 AND term NOT IN (SELECT DISTINCT unnest({_TOK}) FROM documents)")
def new_terms_anti(spark, d):
    return terms.new_terms(terms.distinct_terms(_t(spark, d, "benchmark")), terms.distinct_terms(_t(spark, d, "documents")))


@query(f"""WITH t AS (SELECT doc_id, unnest({_TOK}) AS term FROM documents), n AS (SELECT count(*) AS n FROM documents)
SELECT term, count(DISTINCT doc_id) AS df, round(ln((n - count(DISTINCT doc_id) + 0.5) / (count(DISTINCT doc_id) + 0.5) + 1), 6) AS idf FROM t, n GROUP BY term, n""")
def df_idf(spark, d):
    docs = _t(spark, d, "documents")
    df = terms.document_frequency(terms.postings(docs)).crossJoin(F.broadcast(docs.agg(F.count("*").alias("n"))))
    return df.select("term", "df", F.round(F.log((F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1), 6).alias("idf"))


def _bm25_sql(every: bool) -> str:
    return f"""WITH d AS (SELECT doc_id, {_TOK} AS t FROM documents), s AS (SELECT count(*) AS n, avg(len(t)) AS avgdl FROM d),
p AS (SELECT doc_id, len(t) AS dl, term, count(*) AS tf FROM (SELECT doc_id, t, unnest(t) AS term FROM d) GROUP BY ALL),
f AS (SELECT term, count(*) AS df FROM p GROUP BY term),
q AS (SELECT item_id, term, count(*) AS qtf FROM (SELECT item_id, unnest({_TOK}) AS term FROM benchmark) GROUP BY ALL),
h AS (SELECT item_id, doc_id, round(sum(qtf * ln((n - df + 0.5) / (df + 0.5) + 1) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))), 6) AS score, count(*) AS m FROM q JOIN p USING (term) JOIN f USING (term), s GROUP BY ALL),
r AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM h {"JOIN (SELECT item_id, count(*) AS k FROM q GROUP BY 1) USING (item_id) WHERE m = k" if every else ""})
SELECT item_id, doc_id, score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 50"""


@query(_bm25_sql(False))
def bm25_topk(spark, d):
    return retrieval.bm25(_t(spark, d, "documents"), _t(spark, d, "benchmark"))


@query(_bm25_sql(True))
def and_match(spark, d):
    return retrieval.bm25(_t(spark, d, "documents"), _t(spark, d, "benchmark"), every=True)


def _rank_sql(vector: str) -> str:
    score = f"round(list_cosine_similarity(CAST(a.{vector} AS DOUBLE[]), CAST(b.{vector} AS DOUBLE[])), 6)"
    return f"""SELECT qid, id, hit, label, score, CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS INTEGER) AS rank FROM
(SELECT b.vec_id AS qid, a.vec_id AS id, a.label = b.label AS hit, b.label, {score} AS score FROM embeddings a, embeddings b WHERE a.vec_id <> b.vec_id AND b.vec_id % 20 = 0) QUALIFY rank <= 50"""


_TOP = _rank_sql("embedding")
#: Another ranking of the same ids: by each vector's differences from place to place, the last from the first.
_IDS = _rank_sql("shifted").replace("FROM embeddings a, embeddings b", "FROM _E a, _E b").replace("_E ", "(SELECT *, list_transform(generate_series(1, len(embedding)), lambda i: CAST(embedding[i] AS DOUBLE) - CAST(embedding[i % len(embedding) + 1] AS DOUBLE)) AS shifted FROM embeddings) ")


def _ranked(spark, d, other: bool = False) -> DataFrame:
    """The rows whose id is divisible by 20 as queries against all rows."""
    e = _t(spark, d, "embeddings")
    if other:
        v = F.transform("embedding", lambda x: x.cast("double"))
        e = e.withColumn("embedding", F.zip_with(v, F.concat(F.slice(v, 2, F.size(v) - 1), F.slice(v, 1, 1)), lambda x, y: x - y))
    return retrieval.vectors(e, e.where("vec_id % 20 = 0").withColumnRenamed("vec_id", "qid"), drop_self=True).withColumnRenamed("vec_id", "id")


def _vec(spark, d) -> DataFrame:
    """Every twentieth vector as a query, with whether an answer has its label."""
    labels = _t(spark, d, "embeddings").select("vec_id", "label")
    r = _ranked(spark, d).join(labels.select(F.col("vec_id").alias("id"), F.col("label").alias("found")), "id").join(labels.withColumnRenamed("vec_id", "qid"), "qid")
    return r.select("qid", "id", "score", "rank", (F.col("found") == F.col("label")).alias("hit"), "label")


@query(f"SELECT qid, id, score, rank FROM ({_TOP})")
def cosine_topk(spark, d):
    return _ranked(spark, d).select("qid", "id", "score", "rank")


def _second(spark, d) -> DataFrame:
    return _ranked(spark, d, other=True).select("qid", "id", "rank")


_FUSED = f"""SELECT qid, id, score, CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, first, id) AS INTEGER) AS rank FROM
(SELECT qid, id, round(sum(0.5 / (60 + rank)), 9) AS score, min(leg * 1000 + rank) AS first FROM (SELECT qid, id, rank, 0 AS leg FROM ({_TOP}) UNION ALL SELECT qid, id, rank, 1 FROM ({_IDS})) GROUP BY qid, id)"""


@query(_FUSED)
def rrf_fuse(spark, d):
    return retrieval.fuse(_ranked(spark, d).select("qid", "id", "rank"), _second(spark, d), weights=(0.5, 0.5))


_PAIR = "round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6)"


@query(f"""WITH f AS ({_FUSED}), s AS (SELECT f.*, {_PAIR} AS r FROM f JOIN embeddings a ON a.vec_id = f.qid JOIN embeddings b ON b.vec_id = f.id) SELECT qid, id, CASE WHEN rank <= 20 THEN r ELSE score END AS score,
CAST(row_number() OVER (PARTITION BY qid ORDER BY CASE WHEN rank <= 20 THEN 0 ELSE 1 END, CASE WHEN rank <= 20 THEN r END DESC, rank) AS INTEGER) AS rank FROM s""")
def rerank_head_tail(spark, d):
    f = cut(rrf_fuse(spark, d), "fused")
    e = _t(spark, d, "embeddings")
    pairs = f.where("rank <= 20").join(e.select(F.col("vec_id").alias("qid"), F.col("embedding").alias("a")), "qid").join(e.select(F.col("vec_id").alias("id"), F.col("embedding").alias("b")), "id")
    return retrieval.rerank(f, pairs.select("qid", "id", F.round(X.cosine(F.col("a"), F.col("b")), 6).alias("rerank_score")))


@query(_FUSED.replace("0.5 / (60 + rank)", "1.0 / (60 + rank)"))
def rrf_unweighted(spark, d):
    return retrieval.fuse(_ranked(spark, d).select("qid", "id", "rank"), _second(spark, d))


_PER = f"SELECT qid, label, CAST(max(CAST(hit AND rank <= 1 AS INTEGER)) AS DOUBLE) AS r1, CAST(max(CAST(hit AND rank <= 5 AS INTEGER)) AS DOUBLE) AS r5, coalesce(1.0 / min(CASE WHEN hit AND rank <= 10 THEN rank END), 0.0) AS rr FROM ({_TOP}) GROUP BY ALL"


@query(f"SELECT label, count(*) AS n, round(avg(r1), 6) AS r1, round(avg(r5), 6) AS r5, round(avg(rr), 6) AS rr FROM ({_PER}) GROUP BY label")
def recall_mrr_by_type(spark, d):
    return evaluation.means(evaluation.per_query(_vec(spark, d), "qid", "label"), "label")


@query("SELECT 'cosine' AS method, " + ", ".join(f'round(avg(r5) FILTER (label = {k}), 6) AS "{k}"' for k in range(10)) + f" FROM ({_PER})")
def recall_pivot(spark, d):
    p = evaluation.per_query(_vec(spark, d), "qid", "label").withColumn("method", F.lit("cosine"))
    return evaluation.pivot(p, "method", "label", list(range(10)))


@query("""SELECT qid, clause_no, exhibit, rank, CAST(row_number() OVER (PARTITION BY qid ORDER BY rank) AS INTEGER) AS ordinal FROM
(SELECT qid, CAST(nullif(id % 7, 0) AS VARCHAR) AS clause_no, CAST(nullif(id % 3, 0) AS VARCHAR) AS exhibit, min(rank) AS rank FROM (""" + _IDS + ") GROUP BY 1, 2, 3) WHERE clause_no IS NOT NULL OR exhibit IS NOT NULL")
def citations_first_distinct(spark, d):
    r = _second(spark, d).select("qid", "rank", F.nullif(F.col("id") % 7, F.lit(0)).cast("string").alias("clause_no"), F.nullif(F.col("id") % 3, F.lit(0)).cast("string").alias("exhibit"))
    return retrieval.citations(r)


_DENSE = "regexp_replace({0}, '\\s+', '', 'g')"
_GOLD = f"SELECT item_id, doc_id FROM (SELECT item_id, {_DENSE.format('text')} AS b FROM benchmark) JOIN (SELECT doc_id, {_DENSE.format('text')} AS d FROM documents) ON contains(d, b) WHERE b <> ''"


@query(_GOLD)
def gold_expand(spark, d):
    b = _t(spark, d, "benchmark").select("item_id", X.dense(F.col("text")).alias("span"))
    return contain.containing(_t(spark, d, "documents").select("doc_id", X.dense(F.col("text")).alias("text")), b, "doc_id", "text", "item_id", "span")


@query(f"""WITH r AS ({_bm25_sql(False)}), g AS (SELECT item_id, min(rank) AS best FROM r JOIN ({_GOLD}) USING (item_id, doc_id) GROUP BY 1)
SELECT item_id, CAST(coalesce(best, 0) AS INTEGER) AS best, CASE WHEN best IS NULL THEN 'unreachable' WHEN best <= 3 THEN 'easy' WHEN best <= 10 THEN 'medium' ELSE 'hard' END AS difficulty FROM benchmark LEFT JOIN g USING (item_id)""")
def reachability(spark, d):
    r = bm25_topk(spark, d).join(gold_expand(spark, d), ["item_id", "doc_id"]).groupBy("item_id").agg(F.min("rank").alias("best"))
    b = F.col("best")
    return _t(spark, d, "benchmark").select("item_id").join(r, "item_id", "left").select("item_id", F.coalesce("best", F.lit(0)).alias("best"), F.when(b.isNull(), "unreachable").when(b <= 3, "easy").when(b <= 10, "medium").otherwise("hard").alias("difficulty"))


@query("SELECT conv_id, turn FROM conversations WHERE NOT (contains(text, 'que') OR contains(text, 'nicht') OR contains(role, 'system'))")
def out_of_scope_router(spark, d):
    return retrieval.in_scope(_t(spark, d, "conversations"), "text", "role", hints=["que", "nicht", "system"]).select("conv_id", "turn")


@query("""SELECT conv_id, turn, text AS utterance, coalesce(lag(text) OVER (PARTITION BY conv_id ORDER BY turn), text) AS prev, concat_ws(' / ', role, text) AS report FROM conversations""")
def conversation_variants(spark, d):
    w = Window.partitionBy("conv_id").orderBy("turn")
    return _t(spark, d, "conversations").select("conv_id", "turn", F.col("text").alias("utterance"), F.coalesce(F.lag("text").over(w), "text").alias("prev"), F.concat_ws(" / ", "role", "text").alias("report"))


_NORM = "regexp_replace({0}, '[\\s|․·⋅‧,.\\-()\\[\\]【】〔〕:;''\"]+', '', 'g')"


@query(f"""WITH l AS (SELECT doc_id, line, min(seq) AS seq FROM ({_LINES}) GROUP BY doc_id, line), w AS (SELECT doc_id, {_NORM.format("string_agg(line, '' ORDER BY seq)")} AS a FROM l GROUP BY doc_id),
t AS (SELECT doc_id, {_NORM.format("text")} AS t FROM documents), p AS (SELECT doc_id, substr(t, CAST(i AS BIGINT), 12) AS p FROM t, unnest(generate_series(1, length(t) - 11, 40)) AS s(i) WHERE length(t) >= 12)
SELECT doc_id, count(*) AS probes, count(*) FILTER (coalesce(contains(a, p), false)) AS found FROM p LEFT JOIN w USING (doc_id) GROUP BY doc_id""")
def coverage_probes(spark, d):
    """How much of each document its distinct lines cover."""
    docs = _t(spark, d, "documents")
    kept = segment.first_occurrences(segment.lines(docs), "doc_id", "seq", "line").withColumnRenamed("line", "chunk_text")
    return checks.coverage(docs.select("doc_id", "text"), kept, "doc_id", "seq")


_HEADS = "SELECT page_id, regexp_replace(regexp_extract(html, '<h1[^>]*>([^<]*)</h1>', 1), '\\s+', '', 'g') AS t FROM pages"


@query(f"""WITH h AS (SELECT DISTINCT page_id, t FROM ({_HEADS}) WHERE t <> ''), s AS (SELECT DISTINCT {_DENSE.format("line")} AS s FROM ({_LINES}))
SELECT page_id, t FROM h WHERE NOT EXISTS (SELECT 1 FROM s WHERE contains(s, t))""")
def toc_containment_match(spark, d):
    """Headings that no line of a document contains."""
    h = html_heading_extract(spark, d).select("page_id", X.dense(F.col("heading")).alias("t")).where("t <> ''").distinct()
    lines = segment.lines(_t(spark, d, "documents")).select("doc_id", X.dense(F.col("line")).alias("s"))
    # pages share headings, and each is looked up once
    hit = contain.containing(lines, h.select(F.col("t").alias("__h"), "t").distinct(), "doc_id", "s", "__h", "t").select(F.col("__h").alias("t")).distinct()
    return h.join(hit, "t", "left_anti").select("page_id", "t")


@query("SELECT page_id, regexp_extract(html, '<h1[^>]*>([^<]*)</h1>', 1) AS heading FROM pages")
def html_heading_extract(spark, d):
    return _t(spark, d, "pages").select("page_id", F.regexp_extract("html", "<h1[^>]*>([^<]*)</h1>", 1).alias("heading"))


@query("SELECT doc_id, text FROM documents WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = documents.doc_id)")
def already_ingested_semi(spark, d):
    return _t(spark, d, "documents").join(_t(spark, d, "labels").select("doc_id"), "doc_id", "left_semi").select("doc_id", "text")


@query("SELECT doc_id, text FROM documents WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = documents.doc_id)")
def already_ingested_anti(spark, d):
    return _t(spark, d, "documents").join(_t(spark, d, "labels").select("doc_id"), "doc_id", "left_anti").select("doc_id", "text")


@query("""WITH a AS (SELECT doc_id FROM labels WHERE quality = 1), b AS (SELECT doc_id FROM labels WHERE toxic = 0), c AS (SELECT (SELECT count(DISTINCT doc_id) FROM a) AS found, (SELECT count(DISTINCT doc_id) FROM b) AS truth, (SELECT count(*) FROM (SELECT doc_id FROM a INTERSECT SELECT doc_id FROM b)) AS both)
SELECT found, truth, c.both AS "both", round(c.both / found, 6) AS precision, round(c.both / truth, 6) AS recall FROM c""")
def precision_recall_sets(spark, d):
    t = _t(spark, d, "labels")
    return evaluation.precision_recall(t.where("quality = 1"), t.where("toxic = 0"), "doc_id")


@query("SELECT doc_id FROM labels WHERE quality = 1 INTERSECT SELECT doc_id FROM labels WHERE toxic = 0")
def labels_intersect(spark, d):
    t = _t(spark, d, "labels")
    return t.where("quality = 1").select("doc_id").intersect(t.where("toxic = 0").select("doc_id"))


@query("SELECT doc_id FROM labels WHERE quality = 1 EXCEPT SELECT doc_id FROM labels WHERE toxic = 0")
def labels_except(spark, d):
    t = _t(spark, d, "labels")
    return t.where("quality = 1").select("doc_id").subtract(t.where("toxic = 0").select("doc_id"))
