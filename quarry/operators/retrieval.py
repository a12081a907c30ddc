"""Batches of queries against a corpus: keyword ranking, exact vector ranking, fusion, rerank order and citations.

Every ranking ends in ascending ids, so that ranks are the same however the data are partitioned.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.terms import document_frequency, postings, statistics, tokens_of
from quarry.session import cut, ship_package, small_side

K1, B, CANDIDATES, FUSION_K, RERANK = 1.5, 0.75, 50, 60, 20


def top(rows: DataFrame, query: str, score: str, key: str, k: int, ascending: bool = False) -> DataFrame:
    """The best k rows of each query, with rank from 1; equal scores by ascending key. Spark keeps k rows a task before it shuffles."""
    s = F.col(score).asc() if ascending else F.col(score).desc()
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(query).orderBy(s, F.col(key).asc()))).where(F.col("rank") <= k)


def bm25(docs: DataFrame, queries: DataFrame, key: str = "doc_id", query: str = "item_id", every: bool = False, k: int | None = CANDIDATES, text: str = "text") -> DataFrame:
    """(query, key, score, rank) by Okapi BM25 with idf ln((N - n + .5) / (n + .5) + 1); a token that a query repeats counts each time.

    every: only documents with all of a query's tokens (the production rule), else with any (the evaluation rule). A
    query without tokens has no rows.
    """
    q = queries.select(F.col(query), F.explode(tokens_of(F.col("text"))).alias("term")).groupBy(query, "term").agg(F.count("*").alias("qtf"))
    q = cut(q, "terms")
    if every:  # queries of the same tokens have the same answers, and are looked up once
        same = q.groupBy(query).agg(F.sha2(F.to_json(F.array_sort(F.collect_list(F.struct("term", "qtf")))), 256).alias("__t"), F.count("*").alias("needed"))
        same = cut(same.withColumn("__as", F.min(query).over(Window.partitionBy("__t"))).drop("__t"), "same")
        q = q.join(same.where(F.col(query) == F.col("__as")).select(query, "needed"), query)
    # only the queries' terms need postings and frequencies, so the others go before anything is shuffled; all uses read what is written once
    posts = cut(postings(docs, key, text, small_side(cut(q.select("term").distinct(), "terms"))), "postings")
    q = small_side(cut(q.join(document_frequency(posts), "term"), "weights"))
    if every:
        # an answer has the query's rarest term, too; only documents with that one meet the rest of the query. A term that no document has leaves no answer
        rare = q.groupBy(query, "needed").agg(F.min_by("term", F.struct("df", "term")).alias("term"), F.count("*").alias("have")).where("have = needed")
        some = posts.join(small_side(cut(rare.select(query, "term"), "rare")), "term").select(query, key, "dl")
        pairs = some.join(q, query).join(posts, [key, "dl", "term"])
    else:
        # a document's postings are brought together before they meet the queries, so what each query finds in it is added up without another shuffle
        pairs = posts.repartition(F.col(key)).join(q, "term")
    pairs = pairs.crossJoin(F.broadcast(statistics(docs, text)))
    idf = F.log((F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1)
    part = F.col("qtf") * idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("dl") / F.col("avgdl")))
    agg = [F.round(F.sum(part), 6).alias("score"), F.count("*").alias("matched")]
    if every:
        hits = pairs.groupBy(query, key, "needed").agg(*agg).where("matched = needed").select(query, key, "score")
        best = hits if k is None else top(hits, query, "score", key, k)
        return best.withColumnRenamed(query, "__as").join(same.select(query, "__as"), "__as").select(query, *[c for c in best.columns if c != query])
    hits = pairs.groupBy(query, key).agg(*agg).select(query, key, "score")
    return hits if k is None else top(hits, query, "score", key, k)


def _best(row: np.ndarray, score: np.ndarray, keys: np.ndarray, k: int, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The k best of each row, equal scores by ascending key, and each row's k-th score (what a later one must reach)."""
    order = np.lexsort((keys, -score, row))
    row, score, keys = row[order], score[order], keys[order]
    first = np.searchsorted(row, np.arange(rows + 1))
    keep = np.arange(len(row)) - first[row] < k
    least = np.full(rows, -np.inf)
    full = np.flatnonzero(np.diff(first) >= k)
    least[full] = score[first[full] + k - 1]
    return row[keep], score[keep], keys[keep], least


def _plain(keys: pa.Array) -> np.ndarray:
    """Keys as numbers or as text, which numpy can sort."""
    x = keys.to_numpy(zero_copy_only=False)
    return x.astype(str) if x.dtype == object else x


def _nearest(sent, k: int, drop_self: bool, block: int):
    def unit(x: np.ndarray) -> np.ndarray:
        with np.errstate(invalid="ignore", divide="ignore"):
            return x / np.linalg.norm(x, axis=1, keepdims=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qk, q = sent.value
        q = unit(q)
        best = [None] * -(-len(q) // block)
        for batch in batches:
            for lo in range(0, batch.num_rows, block):
                part = batch.slice(lo, block)
                ck = _plain(part.column(0))
                c = unit(part.column(1).flatten().to_numpy().astype(np.float64).reshape(len(ck), -1))
                by_key = np.argsort(ck, kind="stable")
                ck, c = ck[by_key], c[by_key]
                for j, old in enumerate(best):
                    mine = slice(j * block, (j + 1) * block)
                    s = q[mine] @ c.T
                    s[np.isnan(s)] = -np.inf
                    if drop_self:
                        left, right = np.searchsorted(ck, qk[mine]), np.searchsorted(ck, qk[mine], "right")
                        for i in range(int((right - left).max(initial=0))):
                            own = np.flatnonzero(left + i < right)
                            s[own, left[own] + i] = -np.inf
                    least = np.full(len(s), -np.inf) if old is None else old[3]
                    if np.isinf(least).any() and s.shape[1] > k:
                        least = np.maximum(least, np.partition(s, -k, axis=1)[:, -k])
                    # scores are rounded before they are ranked, so one that much lower may tie
                    row, col = np.nonzero((s >= least[:, None] - 1e-6) & (s > -np.inf))
                    if len(row):
                        new = row, np.round(s[row, col], 6), ck[col]
                        best[j] = _best(*(new if old is None else map(np.concatenate, zip(old[:3], new, strict=True))), k, len(s))
        for j, found in enumerate(best):
            if found is not None:
                yield pa.record_batch({"q": qk[j * block + found[0]], "k": found[2], "score": found[1]})

    return run


def vectors(docs: DataFrame, queries: DataFrame, key: str = "vec_id", query: str = "qid", vector: str = "embedding", k: int = CANDIDATES, drop_self: bool = False, block: int = 1024, slice_bytes: int = 8 << 20) -> DataFrame:
    """(query, key, score, rank) by exact cosine; rows without a vector, and those of length 0, are left out. Keys are whole numbers or strings.

    The corpus is dealt by key over as many tasks as there are cores, once, as a file may be read by one task alone. Queries go to these tasks
    in slices of slice_bytes at most, whatever their number; a task keeps the k best of each query, block by block, so what is shuffled
    after that is k rows a query and task. drop_self: a query's own key is no answer.
    """
    spark = docs.sparkSession
    ship_package(spark)
    kind = lambda df, c: "string" if df.schema[c].dataType.typeName() == "string" else "long"
    side = lambda df, c: df.where(F.col(c).isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0)).select(F.col(c).cast(kind(df, c)).alias("k"), F.col(vector).cast("array<double>").alias("v"))
    c, q = side(docs, key), side(queries, query)
    if docs.schema[vector].dataType.simpleString() == "array<float>":  # half the bytes; tasks make doubles of them
        c = c.withColumn("v", F.col("v").cast("array<float>"))
    c = c.repartition(spark.sparkContext.defaultParallelism, "k")
    n = q.agg(F.sum(8 * F.size("v") + 8)).first()[0] or 0
    slices = max(1, -(-int(n) // slice_bytes))
    if slices > 1:
        q = cut(q, "queries")
    out = []
    for i in range(slices):
        t = q.where(F.pmod(F.xxhash64("k"), F.lit(slices)) == i).toArrow()
        keys = _plain(t.column(0).combine_chunks())
        sent = spark.sparkContext.broadcast((keys, t.column(1).combine_chunks().flatten().to_numpy().reshape(len(keys), -1) if len(keys) else np.zeros((0, 1))))
        out.append(c.mapInArrow(_nearest(sent, k, drop_self, block), f"q {kind(queries, query)}, k {kind(docs, key)}, score double"))
    s = functools.reduce(DataFrame.unionByName, out).select(F.col("q").alias(query), F.col("k").alias(key), "score")
    return top(s, query, "score", key, k)


def check_dimension(docs: DataFrame, dimension: int, vector: str = "embedding") -> DataFrame:
    """docs; reading a vector of another dimension is an error."""
    ok = F.when(F.col(vector).isNull() | (F.size(vector) == dimension), F.col(vector)).otherwise(F.raise_error(F.lit("vector of another dimension")).cast(docs.schema[vector].dataType))
    return docs.withColumn(vector, ok)


def fuse(*legs: DataFrame, query: str = "qid", key: str = "id", weights: tuple[float, ...] | None = None, k: int = FUSION_K) -> DataFrame:
    """Reciprocal-rank fusion of rankings (query, key, rank): sum of weight / (k + rank), a missing leg adding nothing; ties in the order in which the legs, one after another, first name the key."""
    weights = weights or (1.0,) * len(legs)
    parts = [leg.select(query, key, F.col("rank"), F.lit(i).alias("leg"), F.lit(w).alias("w")) for i, (leg, w) in enumerate(zip(legs, weights, strict=True))]
    u = functools.reduce(DataFrame.unionByName, parts)
    s = u.groupBy(query, key).agg(F.round(F.sum(F.col("w") / (k + F.col("rank"))), 9).alias("score"), F.min(F.struct("leg", "rank")).alias("first"))
    w = Window.partitionBy(query).orderBy(F.desc("score"), "first", key)
    return s.withColumn("rank", F.row_number().over(w)).select(query, key, "score", "rank")


def rerank(ranked: DataFrame, scores: DataFrame, query: str = "qid", key: str = "id", head: int = RERANK) -> DataFrame:
    """The first head rows of each query in the order of scores (query, key, rerank_score), the rest unchanged after them; the tail keeps its fused scores."""
    r = ranked.join(scores, [query, key], "left")
    top_part = F.col("rank") <= head
    w = Window.partitionBy(query).orderBy(F.when(top_part, 0).otherwise(1), F.when(top_part, F.col("rerank_score")).desc_nulls_last(), "rank")
    return r.withColumn("new_rank", F.row_number().over(w)).select(query, key, F.when(top_part, F.coalesce("rerank_score", "score")).otherwise(F.col("score")).alias("score"), F.col("new_rank").alias("rank"))


def citations(ranked: DataFrame, query: str = "qid", clause: str = "clause_no", exhibit: str = "exhibit") -> DataFrame:
    """Distinct (clause, exhibit) of each query in the order of their best rank; pairs of nulls are left out."""
    c = ranked.where(F.col(clause).isNotNull() | F.col(exhibit).isNotNull()).groupBy(query, clause, exhibit).agg(F.min("rank").alias("rank"))
    return c.withColumn("ordinal", F.row_number().over(Window.partitionBy(query).orderBy("rank")))


HINTS = ["자동차", "화재", "여행자", "배상책임", "보증보험", "해상보험", "농작물", "반려동물", "운전자", "주택"]


def in_scope(queries: DataFrame, *columns: str, hints: list[str] | None = None) -> DataFrame:
    """Queries none of whose columns contains a hint that it lies outside; nulls contain none."""
    out = F.lit(False)
    for c in columns:
        for h in hints or HINTS:
            out = out | F.coalesce(F.contains(F.col(c), F.lit(h)), F.lit(False))
    return queries.where(~out)


def instruct(query: Column, prefix: str) -> Column:
    """A query with its instruction; documents are embedded as they are."""
    return F.concat(F.lit(prefix), query)


def promote(children: DataFrame, parents: DataFrame, query: str = "qid", k: int = 40) -> DataFrame:
    """Parents in the order of their best child, k of them: children (query, child_id, rank), parents (child_id, parent_id)."""
    p = children.join(parents, "child_id").groupBy(query, "parent_id").agg(F.min("rank").alias("best"))
    return p.withColumn("rank", F.row_number().over(Window.partitionBy(query).orderBy("best", "parent_id"))).where(F.col("rank") <= k).drop("best")


def legs(chunks: DataFrame, queries: DataFrame, every: bool = False) -> tuple[DataFrame, DataFrame]:
    """The rankings (qid, id, rank) of a batch of queries by keywords and by vectors."""
    a = bm25(chunks, queries, "id", "qid", every=every).select("qid", "id", "rank")
    return a, vectors(chunks, queries, "id", "qid").select("qid", "id", "rank")


def search(chunks: DataFrame, queries: DataFrame, top_k: int = 8, reranker: Callable[[DataFrame], DataFrame] | None = None, weights: tuple[float, float] = (0.5, 0.5)) -> DataFrame:
    """Hybrid search of a batch: chunks (id, text, embedding, clause_no, exhibit), queries (qid, text, embedding and, if it has one, insurance_type).

    Out-of-scope queries, by their text or their insurance_type, have no rows. reranker maps (qid, id, text, query text) rows to (qid, id, rerank_score).
    """
    q = in_scope(queries, *[c for c in ("text", "insurance_type") if c in queries.columns])
    a, b = legs(chunks, q, every=True)
    r = fuse(a, b, weights=weights)
    if reranker is not None:
        head = r.where(F.col("rank") <= RERANK).join(chunks.select("id", F.substring("text", 1, 1500).alias("content")), "id").join(q.select("qid", F.col("text").alias("query")), "qid")
        r = rerank(r, reranker(head.select("qid", "id", "content", "query")))
    return r.where(F.col("rank") <= top_k).join(chunks.drop("embedding"), "id")


def answers(chunks: DataFrame, queries: DataFrame, **how) -> DataFrame:
    """(qid, chunks, citations): for each query what search() finds, in order, and the distinct clauses it cites; both are empty where it finds nothing, as for queries out of scope."""
    r = cut(search(chunks, queries, **how), "found")
    found = r.groupBy("qid").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "id", "text", "score"))), lambda x: F.struct(x["id"].alias("id"), x["text"].alias("text"), x["score"].alias("score"))).alias("chunks"))
    cited = citations(r).groupBy("qid").agg(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "clause_no", "exhibit"))), lambda x: F.struct(x["clause_no"].alias("clause_no"), x["exhibit"].alias("exhibit"))).alias("citations"))
    t = queries.select("qid").join(found, "qid", "left").join(cited, "qid", "left")
    empty = lambda c: F.coalesce(c, F.array().cast(t.schema[c].dataType)).alias(c)
    return t.select("qid", empty("chunks"), empty("citations"))


def rewritten(chunks: DataFrame, queries: DataFrame, others: DataFrame) -> DataFrame:
    """Fusion, without weights, of four rankings: queries as they are and rewritten (others, by qid), each by keywords and by vectors."""
    return fuse(*legs(chunks, queries), *legs(chunks, others))


def variant_queries(questions: DataFrame, variants: tuple[str, ...] = ("utterance", "rewritten", "followup", "report")) -> DataFrame:
    """(qid, variant, text, rerank_text): a row for each shape of a question (variants, a struct of texts); a missing one is the question itself. A rewritten query is reranked with what was said."""
    text = lambda v: F.coalesce(F.col(f"variants.{v}"), F.col("question"))
    shapes = [F.struct(F.lit(v).alias("variant"), text(v).alias("text"), text("utterance" if v == "rewritten" else v).alias("rerank_text")) for v in variants]
    return questions.select("qid", F.inline(F.array(*shapes)))


def methods(chunks: DataFrame, queries: DataFrame) -> DataFrame:
    """(method, qid, id, rank): the rankings by keywords (bm25), by vectors (embed) and by both (rrf, without weights)."""
    a, b = (cut(leg, "leg") for leg in legs(chunks, queries))
    named = [d.select(F.lit(n).alias("method"), "qid", "id", "rank") for n, d in (("bm25", a), ("embed", b), ("rrf", fuse(a, b)))]
    return functools.reduce(DataFrame.unionByName, named)
