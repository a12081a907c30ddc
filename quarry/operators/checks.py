"""Quality indicators of chunked documents, and what a validator finds."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from quarry.functions.text import double_spaces, probe_norm
from quarry.session import ship_package

CHUNK_TYPES = ["general", "definition", "coverage", "exclusion", "claim", "duty", "termination", "special_clause", "schedule"]


def integer_gaps(rows: DataFrame, number: str, *by: str) -> DataFrame:
    """Missing integers between the least and the greatest number of each group."""
    return rows.where(F.col(number).isNotNull()).groupBy(*by).agg((F.max(number) - F.min(number) + 1 - F.count_distinct(number)).cast("long").alias("gaps"))


def missing_numbers(rows: DataFrame, number: str, *by: str) -> DataFrame:
    """Groups that miss numbers, with the list of them."""
    g = rows.where(F.col(number).isNotNull()).groupBy(*by).agg(F.sort_array(F.array_except(F.sequence(F.min(number), F.max(number)), F.collect_set(number))).alias("missing"))
    return g.where(F.size("missing") > 0)


def non_monotone(rows: DataFrame, number: str, order: list[str], *by: str) -> DataFrame:
    """Steps back, or ahead by more than 10, along each group, once runs of the same number are one."""
    w = Window.partitionBy(*by).orderBy(*order)
    r = rows.where(F.col(number).isNotNull()).withColumn("p", F.lag(number).over(w)).where(F.col("p").isNull() | (F.col(number) != F.col("p")))
    r = r.withColumn("p", F.lag(number).over(w))
    return r.groupBy(*by).agg(F.count_if((F.col(number) < F.col("p")) | (F.col(number) > F.col("p") + 10)).alias("nonmono"))


def collapsed(gaps: Column, nonmono: Column, sections: Column) -> Column:
    """No gaps, yet more steps back than sections: boundaries were lost."""
    return (gaps == 0) & (nonmono > F.greatest(F.lit(30), sections))


def probe_hits(text: str | None, whole: str | None, size: int = 12, step: int = 40) -> tuple[int, int]:
    """How many pieces of so many characters, every so many, text has, and how many of them whole contains. A piece is looked for shortly after the last one found, and else among all pieces of whole, which are collected once: the work grows with the lengths, not with their product."""
    text, whole = text or "", whole or ""
    at, found, every = 0, 0, None
    starts = range(0, len(text) - size + 1, step)
    for i in starts:
        piece = text[i : i + size]
        near = whole.find(piece, at, at + 20 * step)
        if near >= 0:
            at, found = near, found + 1
            continue
        if every is None:
            every = {whole[j : j + size] for j in range(len(whole) - size + 1)}
        found += piece in every
    return len(starts), found


@F.arrow_udf(StructType([StructField("probes", LongType()), StructField("found", LongType())]))
def _probe_hits(texts: pa.Array, wholes: pa.Array) -> pa.Array:
    rows = [probe_hits(t.as_py(), w.as_py()) for t, w in zip(texts, wholes, strict=True)]
    return pa.StructArray.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in (0, 1)], ["probes", "found"])


def coverage(source: DataFrame, chunks: DataFrame, key: str, order: str, page: str | None = None, text: str = "text", chunk_text: str = "chunk_text", norm: Callable[[Column], Column] = probe_norm) -> DataFrame:
    """(key, page, probes, found): how many of each source text's probes its chunks contain, joined in their order. Both sides are normalised.

    With page, a text is looked up in the chunks of its page and of those before and after it, as a chunk may begin on one and end on the next.
    """
    by = [key] + ([page] if page else [])
    whole = chunks.groupBy(*by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, chunk_text))), lambda x: x[chunk_text]), "").alias("__t"))
    if page:
        near = whole.select(key, F.col(page).alias("__p"), "__t", F.explode(F.sequence(F.col(page) - 1, F.col(page) + 1)).alias(page))
        whole = near.groupBy(*by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__p", "__t"))), lambda x: x["__t"]), "").alias("__t"))
    p = source.select(*by, norm(F.col(text)).alias("__s")).join(whole.select(*by, norm(F.col("__t")).alias("__all")), by, "left")
    ship_package(source.sparkSession)
    return p.select(*by, _probe_hits("__s", "__all").alias("__h")).select(*by, "__h.probes", "__h.found").where("probes > 0")


def worst(covered: DataFrame, key: str, page: str, most: float = 0.5, k: int = 5) -> DataFrame:
    """The k pages of each document that miss most of their probes, of those that miss more than the share most; ties by page."""
    c = covered.select(key, page, F.round(1 - F.col("found") / F.col("probes"), 6).alias("missing")).where(F.col("missing") > most)
    return c.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("missing"), page))).where(F.col("rank") <= k)


def ragged(markdown: Column) -> Column:
    """Whether the lines of a pipe table differ by more than one in their bars; null below two lines."""
    n = F.transform(F.filter(F.split(markdown, "\n"), lambda x: F.contains(x, F.lit("|"))), lambda x: F.length(x) - F.length(F.replace(x, F.lit("|"), F.lit(""))))
    return F.when(F.size(n) >= 2, F.array_max(n) - F.array_min(n) > 1)


def ragged_ratio(chunks: DataFrame, *by: str, content: str = "content") -> DataFrame:
    """(by, tables, ragged): chunks with two rows of a pipe table or more, and the share of them whose rows differ by more than one in their bars."""
    rows = F.filter(F.split(content, "\n"), lambda x: F.rlike(x, F.lit(r"^\s*\|")))
    bars = F.transform(rows, lambda x: F.length(x) - F.length(F.replace(x, F.lit("|"), F.lit(""))))
    t = chunks.select(*by, bars.alias("__n")).where(F.size("__n") >= 2)
    return t.groupBy(*by).agg(F.count("*").alias("tables"), F.round(F.avg((F.array_max("__n") - F.array_min("__n") > 1).cast("double")), 3).alias("ragged"))


def page_recall(source: DataFrame, found: DataFrame, doc: str, page: str) -> DataFrame:
    """(doc, recall): share of a document's pages with a table in the source that have one among the chunks, too."""
    s = source.select(doc, page).distinct().join(found.select(doc, page, F.lit(1).alias("__f")).distinct(), [doc, page], "left")
    return s.groupBy(doc).agg(F.round(F.count("__f") / F.count("*"), 3).alias("recall"))


def win_rate(best: DataFrame, candidates: DataFrame, doc: str = "doc", source: str = "vlm", against: str = "pymupdf") -> DataFrame:
    """(doc, pages, win_rate, gain): how often the best table of a page is from a source, and by how many runs of blanks the best is below the other source's table, on average."""
    other = candidates.where(F.col("source") == against).groupBy(doc, "page").agg(F.min(double_spaces(F.col("markdown"))).alias("__o"))
    b = best.join(other, [doc, "page"], "left")
    return b.groupBy(doc).agg(F.count("*").alias("pages"), F.round(F.avg((F.col("source") == source).cast("double")), 3).alias("win_rate"), F.round(F.avg(F.col("__o") - double_spaces(F.col("markdown"))), 1).alias("gain"))


def adoption(best: DataFrame, *by: str, source: str = "source") -> DataFrame:
    """(by, source, n): how many tables of each source were taken."""
    return best.groupBy(*by, source).agg(F.count("*").alias("n"))


def match_rate(titles: DataFrame, sections: DataFrame, doc: str, title: str = "title", section: str = "section") -> DataFrame:
    """(doc, rate, missing): share of a document's titles that are in one of its sections' labels or have one in them, to three places, and the sorted titles without. Both sides are normalised titles; empty ones don't count."""
    t = titles.where(F.col(title) != "").select(doc, title).distinct()
    s = sections.where(F.col(section) != "").select(doc, section).distinct()
    hit = t.join(s, (t[doc] == s[doc]) & (F.contains(title, section) | F.contains(section, title)), "left_semi").withColumn("__h", F.lit(1))
    j = t.join(hit, [doc, title], "left")
    return j.groupBy(doc).agg(F.round(1 - F.count_if(F.col("__h").isNull()) / F.count("*"), 3).alias("rate"), F.array_sort(F.collect_list(F.when(F.col("__h").isNull(), F.col(title)))).alias("missing"))


def against_baseline(scores: DataFrame, baseline: DataFrame, key: str, score: str = "score", base: str = "base") -> DataFrame:
    """scores with the baseline of each key and what they are above it (null where there is none)."""
    return scores.join(baseline.select(key, base), key, "left").withColumn("delta", F.round(F.col(score) - F.col(base), 3))


def baseline_summary(compared: DataFrame, score: str = "score", base: str = "base") -> DataFrame:
    """One row: mean score, mean baseline (a missing one counts as 0), and the difference."""
    return compared.where(F.col(score).isNotNull()).agg(F.avg(score).alias("s"), F.avg(F.coalesce(base, F.lit(0.0))).alias("b")).select(F.round("s", 3).alias("score"), F.round("b", 3).alias("base"), F.round(F.col("s") - F.col("b"), 3).alias("delta"))


def duplicate_suspicion(chunks: DataFrame, *by: str, content: str = "content", size: int = 200) -> DataFrame:
    """(by, chunks, duplicates): chunks whose first normalised characters an earlier one of the group has."""
    k = F.xxhash64(F.substring(probe_norm(F.coalesce(content, F.lit(""))), 1, size)), F.md5(F.substring(probe_norm(F.coalesce(content, F.lit(""))), 1, size))
    n = chunks.groupBy(*by, k[0].alias("__h"), k[1].alias("__k")).agg(F.count("*").alias("__n"))
    return n.groupBy(*by).agg(F.sum("__n").alias("chunks"), F.sum(F.col("__n") - 1).alias("duplicates"))


def adjacent_duplicates(chunks: DataFrame, key: str, order: list[str], content: str = "content", least: int = 30) -> DataFrame:
    """(key, dup): pairs of equal texts of more than least characters, one of which is the next or the next but one after the other."""
    w, c = Window.partitionBy(key).orderBy(*order), F.col(content)
    same = [F.coalesce((c == F.lead(content, i).over(w)) & (F.length(c) > least), F.lit(False)).cast("long") for i in (1, 2)]
    return chunks.select(key, (same[0] + same[1]).alias("__d")).groupBy(key).agg(F.sum("__d").alias("dup"))


def issues(content: Column, tokens: Column, chunk_type: Column, *required: Column) -> Column:
    """Reasons why a chunk is dropped (blank, tiny) or a warning is due (missing, type, long)."""
    missing = F.lit(False)
    for c in required:
        missing = missing | c.isNull() | (c == "")
    return F.array_compact(
        F.array(
            F.when(F.coalesce(F.regexp_replace(content, r"(?U)\s", ""), F.lit("")) == "", "blank"),
            F.when(tokens < 10, "tiny"),
            F.when(missing, "missing"),
            F.when(~chunk_type.isin(CHUNK_TYPES), "type"),
            F.when(tokens > 600, "long"),
        )
    )


def validate(chunks: DataFrame, *required: str) -> tuple[DataFrame, DataFrame]:
    """Valid chunks, and a row for each issue."""
    c = chunks.withColumn("__issues", issues(F.col("content"), F.col("token_count"), F.col("chunk_type"), *map(F.col, required)))
    bad = F.exists("__issues", lambda x: x.isin("blank", "tiny"))
    return c.where(~bad).drop("__issues"), c.select("chunk_id", F.explode("__issues").alias("issue"))


def skewed(chunks: DataFrame, column: str = "chunk_type", most: float = 0.95) -> DataFrame:
    """One row: the share of the most frequent value, and whether it is over the limit."""
    n = chunks.groupBy(column).count()
    return n.agg(F.max("count").alias("top"), F.sum("count").alias("n")).select("top", "n", F.round(F.col("top") / F.col("n"), 6).alias("share"), (F.col("top") / F.col("n") > most).alias("skewed"))


def unlabelled(chunks: DataFrame, order: list[str], doc: str = "doc_hash") -> DataFrame:
    """Chunks without an article by kind: in an appendix, the first of their section, or other."""
    w = Window.partitionBy(doc).orderBy(*order)
    first = ~F.col("section").eqNullSafe(F.lag("section").over(w)) | (F.row_number().over(w) == 1)
    c = chunks.withColumn("__first", first).where("article_no is null and not is_table and section is not null")
    return c.groupBy(F.when(F.contains("section", F.lit("별표")), "appendix").when(F.col("__first"), "first").otherwise("other").alias("kind")).count()


def restore_rate(chunks: DataFrame, *by: str) -> DataFrame:
    """Share of chunks with a section, other than tables, that have an article."""
    c = chunks.where("section is not null and not is_table")
    return c.groupBy(*by).agg(F.count("*").alias("n"), F.round(F.avg(F.col("article_no").isNotNull().cast("double")), 6).alias("restored"))


def adjusted_restore_rate(chunks: DataFrame, order: list[str], doc: str = "doc_hash") -> DataFrame:
    """One row (total, restored, appendix, first, other, adjusted): chunks with a section, other than tables, by whether they have an article and why not; adjusted is the share restored of those that should have one."""
    w = Window.partitionBy(doc).orderBy(*order)
    first = ~F.col("section").eqNullSafe(F.lag("section").over(w)) | (F.row_number().over(w) == 1)
    c = chunks.withColumn("__first", first).where("section is not null and not is_table")
    none, app = F.col("article_no").isNull(), F.contains("section", F.lit("별표"))
    n = c.agg(F.count("*").alias("total"), F.count_if(~none).alias("restored"), F.count_if(none & app).alias("appendix"), F.count_if(none & ~app & F.col("__first")).alias("first"), F.count_if(none & ~app & ~F.col("__first")).alias("other"))
    return n.withColumn("adjusted", F.round(F.try_divide(F.col("restored").cast("double"), F.col("total") - F.col("appendix") - F.col("first")), 6))


def readiness(chunks: DataFrame, dimension: int) -> DataFrame:
    """(state, message): what a deployment check finds in the store."""
    a = chunks.agg(F.count("*").alias("n"), F.count("embedding").alias("e"), F.max("ingested_at").alias("last"), F.max(F.size("embedding")).alias("d"))
    dup = chunks.groupBy("doc_hash", "section", "article_no").count().where("count > 1").agg(F.count("*").alias("dup"))
    r = a.crossJoin(dup)
    rows = F.array(
        F.struct(F.when(F.col("n") > 0, "OK").otherwise("FAIL").alias("state"), F.concat(F.lit("chunks "), "n").alias("message")),
        F.struct(F.when(F.col("e") == F.col("n"), "OK").otherwise("WARN").alias("state"), F.concat(F.lit("embedded "), "e").alias("message")),
        F.struct(F.when(F.col("d").isNull() | (F.col("d") == dimension), "OK").otherwise("FAIL").alias("state"), F.concat(F.lit("dimension "), F.coalesce(F.col("d").cast("string"), F.lit("none"))).alias("message")),
        F.struct(F.when(F.col("dup") == 0, "OK").otherwise("WARN").alias("state"), F.concat(F.lit("split clauses "), "dup").alias("message")),
        F.struct(F.lit("INFO").alias("state"), F.concat(F.lit("last "), F.coalesce(F.col("last").cast("string"), F.lit("never"))).alias("message")),
    )
    return r.select(F.inline(rows))
