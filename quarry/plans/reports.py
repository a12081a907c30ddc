"""Queries of indicators, grids, hybrid search, ingest and the scans of styled lines, with their SQL.

Prose without Korean would never meet the patterns of titles and articles. The last queries therefore write lines from all rows of
lineitem: what a line says and how it is set follow from the row's own numbers, by an expression that both engines read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.functions import text as X
from quarry.operators import checks, evaluation, ingest, questions, retrieval, scans, segment, terms
from quarry.plans import corpus
from quarry.plans.more import _CHUNKS, _chunks
from quarry.session import cut, small_side

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


@query(f"SELECT source, count(*) AS chunks, CAST(count(*) - count(DISTINCT substr({corpus._NORM.format('text')}, 1, 200)) AS BIGINT) AS duplicates FROM documents GROUP BY source")
def duplicate_suspicion(spark, d):
    return checks.duplicate_suspicion(_t(spark, d, "documents"), "source", content="text")


@query(f"""WITH n AS (SELECT doc_id, line, lead(line, 1) OVER w AS a, lead(line, 2) OVER w AS b FROM ({corpus._LINES}) WINDOW w AS (PARTITION BY doc_id ORDER BY seq))
SELECT doc_id, count(*) FILTER (line = a AND length(line) > 30) + count(*) FILTER (line = b AND length(line) > 30) AS dup FROM n GROUP BY doc_id""")
def adjacent_duplicates(spark, d):
    return checks.adjacent_duplicates(segment.lines(_t(spark, d, "documents")), "doc_id", ["seq"], "line")


@query("""WITH l AS (SELECT source, list_transform(string_split(text, chr(10)), lambda x: 1 + length(x) - length(replace(x, '|', ''))) AS n FROM documents)
SELECT source, count(*) AS tables, round(avg(CAST(list_max(n) - list_min(n) > 1 AS DOUBLE)), 3) AS ragged FROM l WHERE len(n) >= 2 GROUP BY source""")
def ragged_ratio(spark, d):
    """Every line of a document as a row of a table."""
    return checks.ragged_ratio(_t(spark, d, "documents").select("source", F.regexp_replace("text", "(?m)^", "|").alias("content")), "source")


@query("""WITH s AS (SELECT DISTINCT l_orderkey AS doc, l_linenumber AS page FROM lineitem WHERE l_returnflag = 'R'), f AS (SELECT DISTINCT l_orderkey AS doc, l_linenumber AS page FROM lineitem WHERE l_linestatus = 'F')
SELECT doc, round(count(f.page) / count(*), 3) AS recall FROM s LEFT JOIN f USING (doc, page) GROUP BY doc""")
def table_page_recall(spark, d):
    p = _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("page"), "l_returnflag", "l_linestatus")
    return checks.page_recall(p.where("l_returnflag = 'R'"), p.where("l_linestatus = 'F'"), "doc", "page")


_CANDS = "SELECT source AS doc, doc_id // 20 AS page, CASE lang WHEN 'en' THEN 'vlm' WHEN 'fr' THEN 'pymupdf' ELSE lang END AS source, text AS markdown, len(regexp_extract_all(text, '  +')) AS n FROM documents"
_BEST = f"SELECT * FROM ({_CANDS}) QUALIFY row_number() OVER (PARTITION BY doc, page ORDER BY n, CASE source WHEN 'vlm' THEN 1 WHEN 'pymupdf' THEN 2 ELSE 3 END, source) = 1"


def _candidates(spark, d) -> DataFrame:
    s = F.when(F.col("lang") == "en", "vlm").when(F.col("lang") == "fr", "pymupdf").otherwise(F.col("lang"))
    return _t(spark, d, "documents").select(F.col("source").alias("doc"), F.floor(F.col("doc_id") / 20).alias("page"), s.alias("source"), F.col("text").alias("markdown"))


@query(f"""WITH o AS (SELECT doc, page, min(n) AS o FROM ({_CANDS}) WHERE source = 'pymupdf' GROUP BY ALL)
SELECT doc, count(*) AS pages, round(avg(CAST(source = 'vlm' AS DOUBLE)), 3) AS win_rate, round(avg(o - n), 1) AS gain FROM ({_BEST}) LEFT JOIN o USING (doc, page) GROUP BY doc""")
def extractor_win_rate(spark, d):
    c = _candidates(spark, d)
    return checks.win_rate(segment.best_table(c), c)


@query(f"SELECT doc, source, count(*) AS n FROM ({_BEST}) GROUP BY ALL")
def table_source_adoption(spark, d):
    return checks.adoption(segment.best_table(_candidates(spark, d)), "doc")


@query("""WITH w AS (SELECT lang, string_split(text, ' ') AS w FROM documents), t AS (SELECT DISTINCT lang, w[1] AS t FROM w WHERE w[1] <> ''), s AS (SELECT DISTINCT lang, w[2] AS s FROM w WHERE w[2] <> ''),
m AS (SELECT lang, t, EXISTS (SELECT 1 FROM s WHERE s.lang = t.lang AND (contains(t, s) OR contains(s, t))) AS hit FROM t)
SELECT lang, round(1 - count(*) FILTER (NOT hit) / count(*), 3) AS rate, array_to_string(list_sort(list(t) FILTER (NOT hit)), ' ') AS missing FROM m GROUP BY lang""")
def contents_match_rate(spark, d):
    """First words of documents as titles, second words as sections, by language."""
    w = _t(spark, d, "documents").select("lang", F.split("text", " ").alias("w"))
    t, s = w.select("lang", F.get("w", F.lit(0)).alias("title")), w.select("lang", F.get("w", F.lit(1)).alias("section"))
    r = checks.match_rate(t, s, "lang")
    return r.select("lang", "rate", F.when(F.size("missing") > 0, F.array_join("missing", " ")).alias("missing"))


_SCORES = "SELECT source, round(avg(quality), 3) AS score, CASE WHEN source <> 'src1' THEN round(avg(1 - toxic), 3) END AS base FROM documents JOIN labels USING (doc_id) GROUP BY source"


def _scores(spark, d) -> DataFrame:
    j = _t(spark, d, "documents").join(_t(spark, d, "labels"), "doc_id").groupBy("source").agg(F.round(F.avg("quality"), 3).alias("score"), F.round(F.avg(1 - F.col("toxic")), 3).alias("base"))
    return checks.against_baseline(j.select("source", "score"), j.where("source <> 'src1'"), "source")


@query(f"SELECT *, round(score - base, 3) AS delta FROM ({_SCORES})")
def score_against_baseline(spark, d):
    return _scores(spark, d)


@query(f"SELECT round(avg(score), 3) AS score, round(avg(coalesce(base, 0)), 3) AS base, round(avg(score) - avg(coalesce(base, 0)), 3) AS delta FROM ({_SCORES})")
def score_summary(spark, d):
    return checks.baseline_summary(_scores(spark, d))


@query(f"""WITH p AS (SELECT doc_id, lang, CASE WHEN {corpus._CASE} = 'definition' THEN 1 ELSE 0 END AS predicted, n_chars / 1000 AS s FROM documents)
SELECT lang, count(*) AS n, round(avg(CAST(predicted = quality AS DOUBLE)), 6) AS accuracy, round(avg(s), 6) AS latency FROM p JOIN labels USING (doc_id) GROUP BY lang""")
def classifier_accuracy(spark, d):
    p = corpus.keyword_class_first_match(spark, d).join(_t(spark, d, "documents").select("doc_id", "lang", (F.col("n_chars") / 1000).alias("s")), "doc_id")
    p = p.select("doc_id", "lang", (F.col("chunk_type") == "definition").cast("int").alias("predicted"), "s")
    return evaluation.accuracy(p, _t(spark, d, "labels").withColumnRenamed("quality", "gold"), "doc_id", "gold", "predicted", "s", "lang")


@query(f"""WITH c AS (SELECT *, row_number() OVER w = 1 OR section IS DISTINCT FROM lag(section) OVER w AS first FROM ({_CHUNKS}) WINDOW w AS (PARTITION BY doc_hash ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey)),
n AS (SELECT count(*) AS total, count(article_no) AS restored, count(*) FILTER (article_no IS NULL AND contains(section, '별표')) AS appendix, count(*) FILTER (article_no IS NULL AND first AND NOT contains(section, '별표')) AS first, count(*) FILTER (article_no IS NULL AND NOT first AND NOT contains(section, '별표')) AS other FROM c WHERE section IS NOT NULL AND NOT is_table)
SELECT *, round(restored / (total - appendix - first), 6) AS adjusted FROM n""")
def adjusted_restore_rate(spark, d):
    return checks.adjusted_restore_rate(_chunks(spark, d), ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"])


_TERMS = f"SELECT DISTINCT term FROM (SELECT unnest({corpus._TOK}) AS term FROM {{0}}) WHERE length(term) >= 2"


@query(f"WITH d AS ({_TERMS.format('documents')}), k AS ({_TERMS.format('benchmark')}), n AS (SELECT count(*) AS extracted, count(*) FILTER (term NOT IN (SELECT term FROM k)) AS inserted FROM d) SELECT extracted, inserted, inserted + (SELECT count(*) FROM k) AS total FROM n")
def term_rebuild_statistics(spark, d):
    return terms.rebuild(_t(spark, d, "documents"), terms.distinct_terms(_t(spark, d, "benchmark")))[1]


@query("""WITH g AS (SELECT l_orderkey AS doc, list_sort(list(DISTINCT l_linenumber)) AS p FROM lineitem GROUP BY 1)
SELECT doc, unnest(CASE WHEN len(p) <= 3 THEN p ELSE [p[1], p[CAST(floor(len(p) / 3) AS INTEGER) + 1], p[CAST(floor(2 * len(p) / 3) AS INTEGER) + 1]] END) AS page FROM g""")
def even_pages(spark, d):
    return segment.even_pages(_t(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("page")), 3)


@query("SELECT source, doc_id, CAST(row_number() OVER (PARTITION BY source ORDER BY lang, n_chars > 1000, doc_id) AS INTEGER) AS place FROM documents")
def stable_page_order(spark, d):
    p = _t(spark, d, "documents").select("source", "doc_id", "lang", (F.col("n_chars") > 1000).alias("is_table"))
    return segment.in_page_order(p, "source", "doc_id", "lang", "is_table").select("source", "doc_id", "place")


@query("SELECT item_id, version, method, mode FROM benchmark, unnest(['v1', 'v2', 'v3']) AS a(version), unnest(['bm25', 'embed', 'rrf', 'rerank']) AS b(method), unnest(['strict', 'lenient']) AS c(mode)")
def evaluation_grid(spark, d):
    return evaluation.grid(_t(spark, d, "benchmark").select("item_id"), version=["v1", "v2", "v3"], method=["bm25", "embed", "rrf", "rerank"], mode=["strict", "lenient"])


@query("""WITH q AS (SELECT conv_id * 1000 + turn AS qid, text, lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS before, concat_ws(' ', role, text) AS report FROM conversations)
SELECT qid, 'utterance' AS variant, text, text AS rerank_text FROM q UNION ALL SELECT qid, 'rewritten', lower(text), text FROM q UNION ALL SELECT qid, 'followup', coalesce(before, text), coalesce(before, text) FROM q UNION ALL SELECT qid, 'report', report, report FROM q""")
def question_variants(spark, d):
    w = Window.partitionBy("conv_id").orderBy("turn")
    shapes = F.struct(F.col("text").alias("utterance"), F.lower("text").alias("rewritten"), F.lag("text").over(w).alias("followup"), F.concat_ws(" ", "role", "text").alias("report"))
    return retrieval.variant_queries(_t(spark, d, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("qid"), F.col("text").alias("question"), shapes.alias("variants")))


@query("""WITH m AS (SELECT lang, source, round(avg(toxic), 6) AS r5 FROM documents JOIN labels USING (doc_id) GROUP BY ALL)
SELECT m.*, round(m.r5 - coalesce(b.r5, m.r5), 6) AS delta FROM m LEFT JOIN (SELECT source, r5 FROM m WHERE lang = 'en') b USING (source)""")
def variant_deltas(spark, d):
    m = _t(spark, d, "documents").join(_t(spark, d, "labels"), "doc_id").groupBy("lang", "source").agg(F.round(F.avg("toxic"), 6).alias("r5"))
    return evaluation.against(m, "lang", "en", "source")


_Q = "SELECT doc_id AS qid, text, embedding FROM documents JOIN embeddings ON vec_id = doc_id WHERE doc_id % 20 = 0"
_KEYS = corpus._bm25_sql(True).replace("FROM benchmark", f"FROM (SELECT qid AS item_id, text FROM ({_Q}))").replace("FROM documents", "FROM (SELECT doc_id, text FROM documents JOIN embeddings ON vec_id = doc_id)")
_VEC = f"SELECT q.qid, e.vec_id AS id, row_number() OVER (PARTITION BY q.qid ORDER BY round(list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])), 6) DESC, e.vec_id) AS rank FROM ({_Q}) q, embeddings e JOIN documents ON doc_id = vec_id QUALIFY rank <= 50"
_HYBRID = f"""SELECT qid, id, score, CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, first, id) AS INTEGER) AS rank FROM (SELECT qid, id, round(sum(0.5 / (60 + rank)), 9) AS score, min(leg * 1000 + rank) AS first
FROM (SELECT item_id AS qid, doc_id AS id, rank, 0 AS leg FROM ({_KEYS}) UNION ALL SELECT qid, id, rank, 1 FROM ({_VEC})) GROUP BY ALL) QUALIFY rank <= 8"""


def _hybrid(spark, d) -> tuple[DataFrame, DataFrame]:
    e = _t(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    t = _t(spark, d, "documents")
    c = t.join(small_side(cut(e.select("doc_id"), "ids")), "doc_id", "left_semi").join(e, "doc_id")  # texts without a vector aren't shuffled
    c = cut(c.select(F.col("doc_id").alias("id"), "text", "embedding", F.col("lang").alias("clause_no"), F.col("source").alias("exhibit")), "chunks")
    return c, c.where("id % 20 = 0").select(F.col("id").alias("qid"), "text", "embedding")


@query(_HYBRID)
def hybrid_search(spark, d):
    """The texts and vectors of every twentieth document as queries against all."""
    return retrieval.search(*_hybrid(spark, d)).select("qid", "id", "score", "rank")


@query(f"""WITH r AS ({_HYBRID}), c AS (SELECT qid, lang, source, min(rank) AS rank FROM r JOIN documents ON doc_id = id GROUP BY ALL)
SELECT qid, string_agg(id, ' ' ORDER BY rank) AS chunks, (SELECT string_agg(lang || ':' || coalesce(source, ''), ' ' ORDER BY rank) FROM c WHERE c.qid = r.qid) AS citations FROM r GROUP BY qid""")
def hybrid_answers(spark, d):
    a = retrieval.answers(*_hybrid(spark, d))
    return a.select("qid", F.array_join(F.transform("chunks", lambda x: x["id"].cast("string")), " ").alias("chunks"), F.array_join(F.transform("citations", lambda x: F.concat(x["clause_no"], F.lit(":"), F.coalesce(x["exhibit"], F.lit("")))), " ").alias("citations"))


_INGESTED = f"""WITH p AS ({corpus._pack_sql(True, 450).replace("WITH RECURSIVE a AS", "WITH RECURSIVE a AS", 1)}),
k AS (SELECT doc_id, text, row_number() OVER (PARTITION BY doc_id ORDER BY part) AS i FROM p WHERE length(text) * 6 // 10 >= 10)"""


@query(f"""{_INGESTED} SELECT substr(sha256(concat_ws(':', doc_id, source, 1, i)), 1, 24) AS chunk_id, CAST(doc_id AS VARCHAR) AS doc_hash, 'product_summary' AS doc_type, CAST(i AS INTEGER) AS chunk_index, 'general' AS chunk_type,
source || ' | ' || lang || chr(10) || k.text AS content, CAST(length(source || ' | ' || lang || chr(10) || k.text) * 6 // 10 AS INTEGER) AS token_count FROM k JOIN documents USING (doc_id)""")
def ingest_chunks(spark, d):
    """All documents, a page each, from text to valid chunks."""
    return ingest.ingest(*_documents(spark, d))["chunks"].select("chunk_id", "doc_hash", "doc_type", "chunk_index", "chunk_type", "content", "token_count")


@query(f"""{_INGESTED}, n AS (SELECT doc_id, count(*) AS n, count(*) FILTER (length(source || ' | ' || lang || chr(10) || k.text) * 6 // 10 > 600) AS w FROM k JOIN documents USING (doc_id) GROUP BY doc_id)
SELECT CAST(doc_id AS VARCHAR) AS doc_hash, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'SKIPPED' ELSE 'OK' END AS status, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 0 ELSE coalesce(n, 0) END AS chunks, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 0 ELSE coalesce(w, 0) END AS warnings FROM documents LEFT JOIN n USING (doc_id)""")
def ingest_status(spark, d):
    """The same with a store that has the labelled documents."""
    store = _t(spark, d, "labels").select(F.col("doc_id").cast("string").alias("doc_hash"), F.lit("").alias("chunk_id"))
    return ingest.ingest(*_documents(spark, d), store=store)["status"].select("doc_hash", "status", "chunks", "warnings")


def _documents(spark, d) -> tuple[DataFrame, DataFrame]:
    t = _t(spark, d, "documents").withColumn("doc_hash", F.col("doc_id").cast("string"))
    docs = t.select("doc_hash", F.col("source").alias("source_pdf"), F.lit(None).cast("string").alias("doc_type"), F.col("source").alias("insurer"), F.col("lang").alias("product_name"))
    tables = F.array().cast("array<struct<markdown:string,source:string>>")
    return docs, t.select("doc_hash", F.lit(1).alias("page"), F.regexp_replace("text", "\n", "\n\n").alias("text"), tables.alias("tables"))


#: What a line of lineitem says, and how it is set; Spark and DuckDB read the same expression.
_SAYS = """CASE l_partkey % 12 WHEN 0 THEN concat('골절진단비', l_linenumber, ' 특별약관') WHEN 1 THEN '제1조(목적) 이 약관은 정한 바에 따릅니다.' WHEN 2 THEN concat('【별표', l_linenumber, '】 장해분류표') WHEN 3 THEN '의료법 시행령'
WHEN 4 THEN ' - 12 - ' WHEN 5 THEN '5. 기타 특별약관' WHEN 6 THEN concat('13. 일반상해입원일당(1일이상)', l_linenumber, '보장 특별약관') WHEN 7 THEN '무배당 안심상해보험' WHEN 8 THEN '목차 특별약관 ········ 12' WHEN 9 THEN '특별약관'
WHEN 10 THEN concat('회사는 다음과 같이 지급합니다. 그러나 ', l_suppkey, '에 대하여는 지급하지 않습니다.') ELSE concat('(무) 암보험 ', l_suppkey) END"""
_SET = f"SELECT concat('s', l_suppkey) AS doc_hash, l_linenumber AS page, l_orderkey AS block_no, l_partkey AS line_no, {_SAYS} AS text, CAST(CASE WHEN l_partkey % 12 IN (0, 2, 6, 7) THEN 14 WHEN l_quantity > 40 THEN 12 ELSE 10 END AS DOUBLE) AS font_size, l_tax > 0.04 AS is_bold, l_discount > 0.05 AS is_isolated FROM lineitem"


def styled_lines(spark, d) -> DataFrame:
    """Lines of documents, one a supplier, from all rows of lineitem."""
    _t(spark, d, "lineitem").createOrReplaceTempView("__styled")
    t = spark.sql(_SET.replace("FROM lineitem", "FROM __styled"))
    return t.withColumn("page", F.col("page").cast("int"))


_SUF = "(?:특별약관|보통약관|특약|담보)\\s*[ⅠⅡⅢⅣⅤIVX0-9()]*\\s*$"
_DET = f"""WITH l AS ({_SET}), z AS (SELECT doc_hash, font_size, sum(length(text)) AS chars, count(*) FILTER (regexp_matches(regexp_replace(trim(text), '\\s', '', 'g'), '{_SUF}') AND length(trim(text)) <= 60) AS titles FROM l GROUP BY ALL),
b AS (SELECT doc_hash, font_size AS body_size FROM z QUALIFY row_number() OVER (PARTITION BY doc_hash ORDER BY chars DESC, font_size) = 1),
t0 AS (SELECT * FROM z JOIN b USING (doc_hash) WHERE titles >= 4 AND font_size > body_size + 0.8),
t AS (SELECT doc_hash, font_size AS title_size, sum(titles) OVER (PARTITION BY doc_hash) AS evidence FROM t0 QUALIFY row_number() OVER (PARTITION BY doc_hash ORDER BY titles DESC, font_size DESC) = 1),
g AS (SELECT doc_hash, min(page) FILTER (regexp_matches(trim(text), '^제\\s*1\\s*조\\s*[(（【\\[]') AND NOT regexp_matches(text, '[·.]{{4,}}|…{{2,}}')) AS base_start_page FROM l GROUP BY 1),
p AS (SELECT doc_hash, trim(text) AS product FROM l WHERE page <= 3 AND length(trim(text)) BETWEEN 4 AND 40 AND contains(text, '보험') QUALIFY row_number() OVER (PARTITION BY doc_hash ORDER BY starts_with(trim(text), '(무)') DESC, font_size DESC, length(trim(text)) DESC, trim(text) DESC) = 1)"""


@query(f"""{_DET} SELECT doc_hash, body_size, title_size, base_start_page, product, CAST(coalesce(evidence, 0) AS BIGINT) AS evidence, CASE WHEN title_size IS NULL OR base_start_page IS NULL OR product IS NULL OR coalesce(evidence, 0) < 4 THEN 'weak' ELSE 'ok' END AS level,
concat_ws(', ', CASE WHEN title_size IS NULL THEN 'no title size' END, CASE WHEN base_start_page IS NULL THEN 'no first article' END, CASE WHEN product IS NULL THEN 'no product' END, CASE WHEN coalesce(evidence, 0) < 4 THEN 'few titles' END) AS reasons
FROM g LEFT JOIN b USING (doc_hash) LEFT JOIN t USING (doc_hash) LEFT JOIN p USING (doc_hash)""")
def document_signals(spark, d):
    """Type sizes, first article, product and confidence of each document."""
    return scans.detect(styled_lines(spark, d)).withColumn("reasons", F.array_join("reasons", ", "))


_BAD = " OR ".join("regexp_matches(t, '" + p.replace("'", "''") + "')" for p in scans.NOT_TITLE)


@query(f"""{_DET}, x AS (SELECT l.*, trim(text) AS t, body_size, title_size, base_start_page FROM l JOIN b USING (doc_hash) LEFT JOIN t USING (doc_hash) LEFT JOIN g USING (doc_hash))
SELECT doc_hash, block_no, line_no, t, round(CASE WHEN length(t) NOT BETWEEN 2 AND 55 OR {_BAD} THEN 0 ELSE CASE WHEN regexp_matches(t, '{_SUF}') THEN 1.6 ELSE 0 END
+ coalesce(1.4 * least(1.0, greatest(0, font_size - body_size) / greatest(0.1, title_size - body_size)), 0) + CASE WHEN is_bold THEN 1 ELSE 0 END + CASE WHEN is_isolated THEN 0.8 ELSE 0 END + 0.6 * CASE WHEN length(t) < 25 THEN 1 ELSE greatest(0, (60 - length(t)) / 35.0) END
- CASE WHEN regexp_matches(t, '[·.]{{4,}}|…{{2,}}') THEN 2 ELSE 0 END - CASE WHEN regexp_matches(t, '(?:고시|시행령|규칙|법률?)\\s*$') AND NOT regexp_matches(t, '{_SUF}') THEN 1.5 ELSE 0 END END, 6) AS score,
CASE WHEN regexp_matches(t, '^【\\s*별표') THEN replace(replace(replace(t, '【', ''), '】', ''), '  ', ' ') END AS mark FROM x""")
def line_scores(spark, d):
    """What each line is by itself: its score as a title, and whether an appendix begins there."""
    x = styled_lines(spark, d)
    f = scans.line_features(x, scans.detect(x))
    return f.select("doc_hash", "block_no", "line_no", F.trim("text").alias("t"), F.round("score", 6).alias("score"), "mark")


@query()
def section_boundaries(spark, d):
    """Where sections begin; the scan keeps up to three lines between decisions, which tests hold against one document's."""
    return scans.boundaries(styled_lines(spark, d))


@query()
def labelled_fragments(spark, d):
    """Every line as a fragment with the section and article that it stands under."""
    x = styled_lines(spark, d)
    f = x.select("doc_hash", "page", F.lit(False).alias("is_table"), F.row_number().over(Window.partitionBy("doc_hash", "page").orderBy("block_no", "line_no", "text")).alias("seq"), "text")
    found = cut(scans.detect(x), "found")
    return scans.label_articles(f, scans.boundaries(x, found), scans.contents(x, found))


_HEADS = """SELECT concat('s', l_suppkey) AS doc_hash, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_shipdate) AS ord, l_returnflag AS section, l_linenumber AS article_no,
CASE l_partkey % 4 WHEN 0 THEN '본문이 이어집니다.' WHEN 1 THEN concat('제', l_linenumber, '조의', l_suppkey, '(목적)') WHEN 2 THEN concat('제 ', l_linenumber, ' 조 【정의】 ') ELSE concat('제', l_linenumber, '조[지급]') END AS body, l_discount > 0.09 AS is_table FROM lineitem"""
_FLAG = "regexp_matches(trim(body), '^제\\s*\\d+\\s*조(?:의\\s*\\d+)?\\s*(?:[(（\\[【].{1,80}[)）\\]】])\\s*$')"


def _headings(spark, d) -> DataFrame:
    """Lines of which three in four are headings alone, from all rows of lineitem."""
    _t(spark, d, "lineitem").createOrReplaceTempView("__heads")
    return spark.sql(_HEADS.replace("FROM lineitem", "FROM __heads")).withColumn("article_title", F.lit(None).cast("string"))


@query(f"""WITH r AS (SELECT *, NOT is_table AND {_FLAG} AS flag, lag(section) OVER (PARTITION BY doc_hash ORDER BY ord) AS p FROM ({_HEADS})), s AS (SELECT *, sum(CASE WHEN section IS DISTINCT FROM p THEN 1 ELSE 0 END) OVER (PARTITION BY doc_hash ORDER BY ord) AS turn FROM r),
f AS (SELECT *, row_number() OVER w - sum(CAST(flag AS INTEGER)) OVER w AS i FROM s WINDOW w AS (PARTITION BY doc_hash, turn ORDER BY ord)), n AS (SELECT *, CASE WHEN flag THEN count(*) FILTER (flag) OVER (PARTITION BY doc_hash, turn, i) ELSE 0 END AS n FROM f)
SELECT doc_hash, CAST(ord AS INTEGER) AS ord, section, article_no, CAST(NULL AS VARCHAR) AS article_title, body FROM n WHERE n < 2 UNION ALL SELECT doc_hash, CAST(min(ord) AS INTEGER), section, NULL, '인용 조문', string_agg(trim(body), chr(10) ORDER BY ord) FROM n WHERE n >= 2 GROUP BY doc_hash, turn, i, section""")
def merged_heading_runs(spark, d):
    """Runs of bare headings within a section as one row each."""
    return segment.merge_titles(_headings(spark, d)).select("doc_hash", "ord", "section", "article_no", "article_title", "body")


@query(f"""WITH f AS (SELECT doc_hash, ord, {_FLAG} AS f, row_number() OVER (PARTITION BY doc_hash ORDER BY ord) AS r FROM ({_HEADS})), g AS (SELECT doc_hash, ord, r - row_number() OVER (PARTITION BY doc_hash ORDER BY ord) AS i FROM f WHERE f)
SELECT doc_hash, CAST(min(ord) AS INTEGER) AS first, CAST(max(ord) AS INTEGER) AS last, count(*) AS n FROM g GROUP BY doc_hash, i HAVING count(*) >= 3""")
def heading_citation_runs(spark, d):
    """Three bare headings or more in a row."""
    n = _headings(spark, d).select("doc_hash", F.col("ord").alias("seq"), F.trim("body").alias("line"))
    return segment.citation_runs(n, "doc_hash")


_PROBE = f"SELECT doc_id, seq, concat_ws(chr(10), line, lead(line, 1) OVER w, lead(line, 2) OVER w) AS probe, lag(line) OVER w AS before FROM ({corpus._LINES}) WINDOW w AS (PARTITION BY doc_id ORDER BY seq)"


@query(f"SELECT doc_id, CAST(seq AS INTEGER) AS seq, probe, before FROM ({_PROBE})")
def three_line_probes(spark, d):
    return segment.three_lines(segment.lines(_t(spark, d, "documents")), "doc_id")


_TITLES = "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE l_returnflag WHEN 'A' THEN concat('별표', l_linenumber, ' 표') WHEN 'N' THEN concat(l_linenumber, '. 골절 특별약관') ELSE concat('보통 ', l_suppkey) END AS s FROM lineitem"


@query(f"SELECT CASE WHEN starts_with(s, '별표') OR contains(s, '분류표') THEN '별표' WHEN contains(s, '특별약관') OR contains(s, '특약') THEN '특별약관' ELSE '보통약관' END AS kind, regexp_replace(regexp_replace(trim(s), '^\\d+\\.\\s*', ''), '\\s+', '', 'g') AS title, count(*) AS n FROM ({_TITLES}) GROUP BY 1, 2")
def section_kinds(spark, d):
    _t(spark, d, "lineitem").createOrReplaceTempView("__titles")
    s = spark.sql(_TITLES.replace("FROM lineitem", "FROM __titles"))
    return s.groupBy(X.section_kind(F.col("s")).alias("kind"), X.boundary_norm(F.col("s")).alias("title")).agg(F.count("*").alias("n"))


@query("""WITH t AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents), p AS (SELECT *, CASE WHEN contains(l[1], ' | ') AND NOT regexp_matches(l[1], '^\\s*\\|') THEN l[2:] ELSE l END AS r FROM t)
SELECT doc_id, CASE WHEN (len(r) < len(l) OR regexp_matches(trim(r[1]), '^\\[.*\\]$')) AND trim(array_to_string(list_filter(r, lambda x: NOT regexp_matches(trim(x), '^\\[.*\\]$')), '')) <> '' THEN 'header' ELSE 'plain' END AS kind,
length(regexp_replace(text, '[\\s|·\\-–—]+', '', 'g')) AS dense, length(regexp_replace(text, '[\\s\\d|·.,()（）\\[\\]【】''"~\\-–—]+', '', 'g')) AS letters FROM p""")
def text_normalisers(spark, d):
    t = F.col("text")
    kind = F.when(X.body_of(t) == X.strip(t), "plain").when(F.length(X.body_of(t)) < F.length(X.strip(t)), "header").otherwise("plain")
    return _t(spark, d, "documents").select("doc_id", kind.alias("kind"), F.length(X.integrity_norm(t)).cast("long").alias("dense"), F.length(F.regexp_replace(t, X._BOILER, "")).cast("long").alias("letters"))


@query("SELECT lang, CASE WHEN n_chars < 500 THEN 'easy' WHEN n_chars < 2000 THEN 'medium' ELSE 'hard' END AS difficulty, CASE WHEN quality = 1 THEN 'low' ELSE 'high' END AS ambiguity, count(*) AS n, round(avg(length(text)), 2) AS mean_length FROM documents JOIN labels USING (doc_id) GROUP BY ALL")
def question_profile(spark, d):
    q = _t(spark, d, "documents").join(_t(spark, d, "labels"), "doc_id")
    level = F.when(F.col("n_chars") < 500, "easy").when(F.col("n_chars") < 2000, "medium").otherwise("hard")
    q = q.select(F.col("lang").alias("qtype"), level.alias("difficulty"), F.when(F.col("quality") == 1, "low").otherwise("high").alias("ambiguity"), F.col("text").alias("question"))
    return questions.profile(q).withColumnRenamed("qtype", "lang")
