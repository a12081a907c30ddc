"""Question sets made by a model outside: choice of candidates, rules, reachability, difficulty and variants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.text import dense
from quarry.operators.contain import frequency


def candidates(chunks: DataFrame, n: int, stratum: str = "chunk_type", seed: int = 7, key: str = "chunk_id") -> DataFrame:
    """One of each group of equal texts (first 400 characters without spaces), then n by turns over the strata, large ones first; the order within a stratum is that of a seeded hash."""
    c = chunks.withColumn("__k", F.substring(dense(F.col("content")), 1, 400)).withColumn("__r", F.row_number().over(Window.partitionBy("__k").orderBy(key))).where("__r = 1")
    c = c.withColumn("__t", F.row_number().over(Window.partitionBy(stratum).orderBy(F.xxhash64(F.lit(seed), F.col(key)), key))).withColumn("__n", F.count("*").over(Window.partitionBy(stratum)))
    return c.orderBy("__t", F.desc("__n"), stratum).limit(n).drop("__k", "__r", "__t", "__n")


def reject(question: Column, span: Column, content: Column, leak: Column, outside: Column) -> Column:
    """Why a question is no good, or null: its length, reference to itself, a topic outside, a span that isn't in the text, or words taken over."""
    return (
        F.when(~F.length(question).between(10, 65), "length").when(F.rlike(question, F.lit("이 조항|이 약관|본 약관|위 내용|해당 조")), "self_ref").when(outside, "oos_guard")
        .when(~F.coalesce(F.contains(dense(content), dense(span)), F.lit(False)), "span_anchor").when(leak >= 14, "leak")
    )


def rare_keywords(questions: DataFrame, df: DataFrame, n_chunks: int, share: float = 0.015) -> DataFrame:
    """(qid, keywords): the two rarest keywords of each question that few enough chunks have and its own chunk contains; questions (qid, content, keywords), df (term, df)."""
    k = questions.select("qid", "content", F.explode("keywords").alias("term")).join(df, "term")
    k = k.where((F.col("df") <= max(2, int(n_chunks * share))) & F.length("term").between(2, 40) & F.contains(dense(F.col("content")), dense(F.col("term"))))
    return k.groupBy("qid").agg(F.transform(F.slice(F.array_sort(F.collect_set(F.struct("df", "term"))), 1, 2), lambda x: x["term"]).alias("keywords"))


def keyword_frequency(keywords: DataFrame, chunks: DataFrame) -> DataFrame:
    """(term, df): chunks whose text without spaces contains the keyword without spaces; a keyword that none has isn't there."""
    k = keywords.select("term", dense(F.col("term")).alias("word")).distinct()
    return frequency(chunks.select(dense(F.col("content")).alias("content")), k, "content", "term", "word")


def difficulty(best: Column) -> Column:
    """By the best rank, from 0."""
    return F.when(best < 3, "easy").when(best < 10, "medium").otherwise("hard")


def ambiguity(sections: Column) -> Column:
    return F.when(sections >= 8, "high").when(sections > 1, "mid").otherwise("low")


def reachable(gold: DataFrame, *legs: DataFrame) -> DataFrame:
    """(qid, best, sections): questions of which a leg (qid, chunk_id, rank from 1) has a gold chunk within 50; gold (qid, chunk_id, section)."""
    out = None
    for leg in legs:
        r = leg.where("rank <= 50").join(gold.select("qid", "chunk_id"), ["qid", "chunk_id"]).select("qid", (F.col("rank") - 1).alias("r"))
        out = r if out is None else out.unionByName(r)
    s = gold.groupBy("qid").agg(F.count_distinct("section").alias("sections"))
    return out.groupBy("qid").agg(F.min("r").alias("best")).join(s, "qid")


def hard_negatives(ranked: DataFrame, gold: DataFrame, top: int = 20) -> DataFrame:
    """(qid, chunk_id): the first of each ranking's top that isn't gold."""
    r = ranked.where(F.col("rank") <= top).join(gold.select("qid", "chunk_id"), ["qid", "chunk_id"], "left_anti")
    return r.groupBy("qid").agg(F.min_by("chunk_id", "rank").alias("chunk_id"))


def accept_apart(vectors: DataFrame, order: str = "ord", least: float = 0.93) -> DataFrame:
    """Rows in order, without those whose cosine with one accepted before is least or more; what is accepted depends on the order, so the questions of one set (group) are one task."""
    import numpy as np
    import pandas as pd

    def scan(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        x = np.stack(pdf["embedding"].to_list()).astype(float)
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
        kept: list[int] = []
        for i in range(len(x)):
            if not kept or (x[kept] @ x[i]).max() < least:
                kept.append(i)
        return pdf.iloc[kept]

    return vectors.groupBy("group").applyInPandas(scan, vectors.schema)


def out_of_scope_variants(names: list[str], struct: str, hints: list[str]) -> Column:
    """Names of the variants that contain a hint."""
    return F.array_compact(F.array(*[F.when(F.exists(F.array(*map(F.lit, hints)), lambda h, n=n: F.contains(F.col(f"{struct}.{n}"), h)), n) for n in names]))


def profile(questions: DataFrame) -> DataFrame:
    """Questions by type, difficulty and ambiguity, with their mean length."""
    return questions.groupBy("qtype", "difficulty", "ambiguity").agg(F.count("*").alias("n"), F.round(F.avg(F.length("question")), 2).alias("mean_length"))
