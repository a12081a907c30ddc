"""Terms, postings and corpus statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import cut

KEPT_TAGS = ("NN", "VV", "VA", "SN", "SL", "XR")


def analysed(rows: DataFrame, analyse, text: str = "text", stop: frozenset[str] = frozenset(), least: int = 2) -> DataFrame:
    """rows with tokens, an array of words: those of a morphological analyser, a function of a text that gives (form, tag) pairs, with one of the tags kept, of so many characters, and no stop words. A text that it fails on, and every text without an analyser, is cut at white space."""
    if analyse is None:
        return rows.withColumn("tokens", tokens_of(F.col(text)))

    @F.udf("array<string>", useArrow=True)
    def words(t):
        try:
            return [form for form, tag in analyse(t) if tag.startswith(KEPT_TAGS) and len(form) >= least and form not in stop]
        except Exception:  # an analyser's failure is one text's
            return None

    return rows.withColumn("tokens", F.coalesce(words(F.coalesce(text, F.lit(""))), tokens_of(F.col(text))))


def tokens_of(text) -> F.Column:
    """Lower-case words between white space; the tokeniser without a morphological analyser."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"(?U)\s+"), lambda x: x != "")


def postings(docs: DataFrame, key: str = "doc_id", text: str = "text", only: DataFrame | None = None) -> DataFrame:
    """(key, term, tf) of every term of every document, or of the terms only, and the document's length in terms."""
    t = docs.select(F.col(key), tokens_of(F.col(text)).alias("t"))
    t = t.select(key, F.size("t").alias("dl"), F.explode("t").alias("term"))
    if only is not None:
        t = t.join(only, "term", "left_semi")
    return t.groupBy(key, "dl", "term").agg(F.count("*").alias("tf"))


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row: number of documents and mean length in terms."""
    return docs.select(F.size(tokens_of(F.col(text))).alias("dl")).agg(F.count("*").alias("n"), F.avg("dl").alias("avgdl"))


def document_frequency(posts: DataFrame) -> DataFrame:
    return posts.groupBy("term").agg(F.count("*").alias("df"))


def distinct_terms(docs: DataFrame, text: str = "text", least: int = 2) -> DataFrame:
    """Distinct terms of so many characters or more."""
    return docs.select(F.explode(tokens_of(F.col(text))).alias("term")).distinct().where(F.length("term") >= least)


def new_terms(incoming: DataFrame, known: DataFrame) -> DataFrame:
    """Terms to append: those not yet known."""
    return incoming.join(known.select("term"), "term", "left_anti")


def rebuild(docs: DataFrame, known: DataFrame | None, text: str = "text", least: int = 2) -> tuple[DataFrame, DataFrame]:
    """Terms to append, and one row of statistics: terms extracted, new ones, and how many are known afterwards."""
    found = cut(distinct_terms(docs, text, least), "terms")
    fresh = found if known is None else new_terms(found, known)
    before = found.sparkSession.range(1).select(F.lit(0).cast("long").alias("before")) if known is None else known.agg(F.count("*").alias("before"))
    stats = found.agg(F.count("*").alias("extracted")).crossJoin(F.broadcast(fresh.agg(F.count("*").alias("inserted")))).crossJoin(F.broadcast(before))
    return fresh, stats.select("extracted", "inserted", (F.col("before") + F.col("inserted")).alias("total"))


def trigram_similar(terms: DataFrame, words: DataFrame, least: float = 0.3) -> DataFrame:
    """Pairs of a word and a term whose sets of trigrams (padded with two blanks and one) have a Jaccard similarity of least or more: an extension."""
    grams = lambda d, n: d.select(F.col(n), F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(n) + 1), lambda i: F.substr(F.concat(F.lit("  "), F.col(n), F.lit(" ")), i, F.lit(3))))).alias("g"))
    a, b = grams(words.withColumnRenamed("term", "word"), "word"), grams(terms, "term")
    size = lambda d, n, s: d.groupBy(n).agg(F.count("*").alias(s))
    both = a.join(b, "g").groupBy("word", "term").agg(F.count("*").alias("common"))
    j = both.join(size(a, "word", "na"), "word").join(size(b, "term", "nb"), "term")
    return j.withColumn("similarity", F.col("common") / (F.col("na") + F.col("nb") - F.col("common"))).where(F.col("similarity") >= least).select("word", "term", "similarity")
