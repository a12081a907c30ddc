"""Segmentation of ordered text: paragraphs, lines, fragments, greedy packing, runs, splits and final chunk rows.

Order is always explicit: (page, is_table, seq) or a line number. Greedy packing restarts its counter at each flush, so it
is one pass over the sorted parts and not a bucket of a running sum.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from quarry.functions.text import chunk_key, strip, tokens
from quarry.session import ship_package

TARGET, HARD_MAX, PLAIN_LIMIT, TABLE_ROWS = 500, 1000, 450, 20
FOOTER = r"(?U)^\s*[-‐–—]\s*\d{1,3}\s*[-‐–—]\s*$"
TOC_MARK = r"[·.]{6,}|…{3,}"
ENUM_HEAD = r"(?U)^\s*(?:\d{1,2}\s*[.)]|[①-⑳]|[가나다라마바사아자차카타파하]\s*[.)])\s+\S"
HEADING = r"(?U)^제\s*\d+\s*조(?:의\s*\d+)?\s*(?:[(（\[【].{1,80}[)）\]】])\s*$"


def paragraphs(text: Column, separator: str = r"\n{2,}") -> Column:
    """Trimmed parts that aren't blank."""
    return F.filter(F.transform(F.split(text, separator), strip), lambda x: x != "")


def lines(docs: DataFrame, key: str = "doc_id", text: str = "text", separator: str = "\n") -> DataFrame:
    """(key, seq, line): the parts of each text that aren't blank, numbered from 1."""
    return docs.select(F.col(key), F.posexplode(paragraphs(F.col(text), separator)).alias("seq", "line")).withColumn("seq", F.col("seq") + 1)


ARTICLE_LINE = r"(?m)^제\d+조(?:의\d+)?\s*\((?:[^()\n]|\([^()\n]{0,20}\)){1,50}(?:\)?\s*$|\)\s*(?=①|1\.\s))"


@F.udf(ArrayType(StringType()), useArrow=True)
def article_parts(text: str) -> list[str]:
    """A paragraph, cut before each line that is an article's heading, unless fewer than four characters lie between it and the one before or after: then it is of a list."""
    if text is None:
        return []
    heads = [m.span() for m in re.finditer(ARTICLE_LINE, text)]
    near = [len("".join(text[a[1] : b[0]].split())) < 4 for a, b in zip(heads, heads[1:], strict=False)]
    alone = [not before and not after for before, after in zip([False, *near], [*near, False], strict=True)]
    at = [0, *[a for (a, _), ok in zip(heads, alone, strict=False) if ok and a > 0], len(text)]
    return [p for p in (text[i:j].strip() for i, j in zip(at, at[1:], strict=False)) if p]


def front_matter(pages: DataFrame, found: DataFrame, doc: str = "doc_hash") -> DataFrame:
    """pages without those before the one where the base terms begin; all pages where no such page was found."""
    return pages.join(found.select(doc, "base_start_page"), doc, "left").where(F.col("page") >= F.coalesce("base_start_page", F.lit(0))).drop("base_start_page")


def even_pages(pages: DataFrame, n: int, doc: str = "doc", page: str = "page") -> DataFrame:
    """(doc, page): n pages of each document, spread evenly over the distinct ones in order, or all if there are no more."""
    g = pages.groupBy(doc).agg(F.array_sort(F.collect_set(page)).alias("p"))
    at = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.get("p", F.floor(i * F.size("p") / n).cast("int")))
    return g.select(doc, F.explode(F.when(F.size("p") <= n, F.col("p")).otherwise(at)).alias(page))


def in_page_order(parts: DataFrame, doc: str, ordinal: str, *by: str) -> DataFrame:
    """parts with place, from 1: by page and the like, and where these are equal in the order they had before."""
    return parts.withColumn("place", F.row_number().over(Window.partitionBy(doc).orderBy(*by, ordinal)))


def three_lines(numbered: DataFrame, key: str) -> DataFrame:
    """(key, seq, probe, before): each line with the two after it, for headings that go over lines, and the one before it."""
    w = Window.partitionBy(key).orderBy("seq")
    return numbered.select(key, "seq", F.concat_ws("\n", "line", F.lead("line", 1).over(w), F.lead("line", 2).over(w)).alias("probe"), F.lag("line").over(w).alias("before"))


def fragments(pages: DataFrame) -> DataFrame:
    """Paragraphs and tables of pages (doc, page, text, tables) as (doc, page, is_table, seq, text, source)."""
    text = pages.select("doc", "page", F.posexplode(paragraphs(F.col("text"))).alias("seq", "text")).select("doc", "page", F.lit(False).alias("is_table"), "seq", "text", F.lit(None).cast("string").alias("source"))
    tables = pages.select("doc", "page", F.posexplode("tables").alias("seq", "t")).select("doc", "page", F.lit(True).alias("is_table"), "seq", F.col("t.markdown").alias("text"), F.col("t.source").alias("source"))
    return text.unionByName(tables.where(strip(F.col("text")) != ""))


def without_lines(text: Column, *patterns: str) -> Column:
    """The text without the lines that match a pattern."""
    bad = lambda x: F.reduce(F.array(*[F.rlike(x, F.lit(p)) for p in patterns]), F.lit(False), lambda a, b: a | b)
    return F.array_join(F.filter(F.split(text, "\n"), lambda x: ~bad(x)), "\n")


def pack(sizes: Iterable[int], size: int, before: bool) -> Iterator[int]:
    """Group of each item, from 0. After: a group ends with the item that brings its sum to size. Before: a new group begins with the item that would bring the sum over it."""
    group = total = 0
    for n in sizes:
        if before and total > 0 and total + n > size:
            group, total = group + 1, 0
        yield group
        total += n
        if not before and total >= size:
            group, total = group + 1, 0


def packed(parts: DataFrame, key: str, before: bool, size: int, *label: str) -> DataFrame:
    """Ordered parts (key, seq, line and labels) as packed texts (key, run, labels, part, first_seq, n, text). A change of label ends a group, and a run of equal labels is packed on its own.

    Parts are brought together and sorted by key once, and read in one pass that holds the text of one pack at a time.
    """
    ship_package(parts.sparkSession)
    p = parts.select(key, *label, F.col("seq").cast("int").alias("seq"), F.coalesce(tokens(F.col("line")), F.lit(0)).alias("__n"), F.coalesce("line", F.lit("")).alias("line")).repartition(F.col(key)).sortWithinPartitions(key, "seq")
    names = [key, *label]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        last = run_key = object()  # of no row
        runs = group = total = 0
        held: list[str] = []
        first = None

        def close() -> None:
            if held:
                out.append((*run_key, runs, group, first, len(held), "\n".join(held)))
                held.clear()

        def rows() -> pa.RecordBatch:
            cols = list(zip(*out, strict=True)) if out else [[]] * len(schema)
            out.clear()
            return pa.record_batch([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

        for batch in batches:
            cols = [c.to_pylist() for c in batch.columns]
            for *who, seq, n, line in zip(*cols, strict=True):
                who = tuple(who)
                if who != run_key:
                    close()
                    runs = runs + 1 if who[0] == last else 0 if not label else 1
                    last, run_key, group, total = who[0], who, 0, 0
                elif before and total > 0 and total + n > size:
                    close()
                    group, total = group + 1, 0
                if not held:
                    first = seq
                held.append(line)
                total += n
                if not before and total >= size:
                    close()
                    group, total = group + 1, 0
            yield rows()
        close()
        yield rows()

    types = {f.name: f.dataType for f in p.schema.fields}
    spark_schema = StructType([StructField(c, types[c]) for c in names] + [StructField("run", LongType()), StructField("part", IntegerType()), StructField("first_seq", IntegerType()), StructField("n", LongType()), StructField("text", StringType())])
    schema = to_arrow_schema(spark_schema)
    return p.mapInArrow(run, spark_schema).select(key, "run", *label, "part", "first_seq", "n", "text")


def runs(rows: DataFrame, flag: Column, key: str, order: str, least: int) -> DataFrame:
    """Gaps and islands: (key, first, last, n) of runs of at least so many rows in a row for which flag holds."""
    w = Window.partitionBy(key).orderBy(order)
    r = rows.select(key, order, flag.alias("__f"), F.row_number().over(w).alias("__r")).where("__f")
    r = r.withColumn("__i", F.col("__r") - F.row_number().over(w))
    return r.groupBy(key, "__i").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("n")).where(F.col("n") >= least).drop("__i")


def merged_runs(rows: DataFrame, flag: Column, key: str, order: str, text: str, least: int = 2) -> DataFrame:
    """rows, where each run of at least so many for which flag holds is one row: its first row's columns with the texts joined by line breaks (and last, the order of its last row); no other row changes."""
    w = Window.partitionBy(key).orderBy(order)
    r = rows.withColumn("__f", F.coalesce(flag, F.lit(False)))
    r = r.withColumn("__i", F.row_number().over(w) - F.sum(F.col("__f").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    r = r.withColumn("__n", F.when(F.col("__f"), F.count_if("__f").over(Window.partitionBy(key, "__i"))).otherwise(0))
    one = r.where(F.col("__n") < least).select(*rows.columns, F.col(order).alias("last"))
    rest = [c for c in rows.columns if c not in (key, text)]
    many = r.where(F.col("__n") >= least).groupBy(key, "__i").agg(F.min_by(F.struct(*rest), order).alias("__r"), F.array_sort(F.collect_list(F.struct(order, text))).alias("__t"), F.max(order).alias("last"))
    many = many.select(key, *[F.col(f"__r.{c}").alias(c) for c in rest], F.array_join(F.transform("__t", lambda x: strip(x[text])), "\n").alias(text), "last")
    return one.unionByName(many.select(*one.columns))


def merge_titles(merged: DataFrame, key: str = "doc_hash", order: str = "ord", text: str = "body") -> DataFrame:
    """Rows (section, article_no, article_title and a body) of which two or more in a row and in one section are nothing but an article's heading become one, without a number and titled 인용 조문."""
    flag = ~F.col("is_table") & F.rlike(strip(F.col(text)), F.lit(HEADING))
    w = Window.partitionBy(key).orderBy(order)
    turn = F.sum((~F.col("section").eqNullSafe(F.lag("section").over(w))).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    m = merged.withColumn("__s", turn).withColumn("__key", F.struct(key, "__s"))
    r = merged_runs(m, flag, "__key", order, text)
    many = F.col("last") != F.col(order)
    return r.select(*[F.when(many, {"article_no": F.lit(None), "article_title": F.lit("인용 조문")}.get(c, F.col(c))).otherwise(F.col(c)).alias(c) if c in ("article_no", "article_title") else F.col(c) for c in merged.columns])


def citation_runs(numbered: DataFrame, key: str = "doc_id", least: int = 3) -> DataFrame:
    """Three heading-only lines or more in a row are a list of citations, and no headings."""
    return runs(numbered, F.col("line").rlike(HEADING), key, "seq", least)


def split_before(text: Column, pattern: str) -> Column:
    """Parts of a text, each of which but the first begins at a match of pattern."""
    return F.filter(F.split(text, f"(?={pattern})"), lambda x: strip(x) != "")


def enumerated(text: Column, least_tokens: int = 400, least_items: int = 4) -> Column:
    """A long list article as its items, each with the introduction before it; other texts as one part."""
    ls = F.split(text, "\n")
    heads = F.filter(F.transform(ls, lambda x, i: F.when(F.rlike(x, F.lit(ENUM_HEAD)), i)), lambda x: x.isNotNull())
    ends = F.concat(F.slice(heads, 2, F.greatest(F.size(heads) - 1, F.lit(0))), F.array(F.size(ls)))
    join = lambda a, n: F.array_join(F.slice(ls, a + 1, n), "\n")
    intro = F.when(F.get(heads, F.lit(0)) > 0, join(F.lit(0), F.get(heads, F.lit(0))))
    parts = F.transform(heads, lambda h, i: F.concat_ws("\n", intro, join(h, F.get(ends, i) - h)))
    return F.when((tokens(text) >= least_tokens) & (F.size(heads) >= least_items), parts).otherwise(F.array(text))


@F.udf(ArrayType(StringType()), useArrow=True)
def _line_packs(text: str, target: int) -> list[str]:
    packs: list[list[str]] = []
    size = 0
    for line in text.split("\n"):
        joined = size + 1 + len(line) if packs and size else len(line)
        if packs and (size == 0 or joined * 6 // 10 <= target):
            packs[-1].append(line)
        else:
            packs.append([line])
            joined = len(line)
        size = joined
    return [t for t in ("\n".join(p).lstrip("\n") for p in packs) if t]


def hard_split(text: Column, hard_max: int = HARD_MAX, target: int = TARGET) -> Column:
    """A text over hard_max as packs of lines of at most target tokens; a longer line stands alone, and empty lines begin no pack."""
    return F.when(tokens(text) > hard_max, _line_packs(F.when(tokens(text) > hard_max, text).otherwise(""), F.lit(target))).otherwise(F.array(text))


@F.udf(ArrayType(StringType()), useArrow=True)
def _glued(parts: list[str], least: int) -> list[str]:
    out: list[list[str]] = []
    for x in parts if parts is not None else []:
        if out and len(x.strip()) < least:
            out[-1].append(x)
        else:
            out.append([x])
    return ["".join(p) for p in out]


def children(text: Column, least: int = 40) -> Column:
    """Small-to-big: parts that begin at circled digits or numbered lines; a part of fewer characters is glued to the one before."""
    return F.when(text.isNotNull(), _glued(split_before(text, r"[①-⑳]|(?<=\n)\d{1,2}\. "), F.lit(least)))


def table_rows(markdown: Column) -> Column:
    """(header lines, rows) of a pipe table: the header ends with the separator line, or is the first line."""
    ls = F.filter(F.split(markdown, "\n"), lambda x: F.rlike(x, F.lit(r"^\s*\|")))
    sep = F.array_position(F.transform(ls, lambda x: F.rlike(x, F.lit(r"^[\s|:\-]+$"))), True).cast("int")
    n = F.when(sep > 0, sep).otherwise(F.lit(1))
    return F.struct(F.slice(ls, 1, n).alias("header"), F.slice(ls, n + 1, F.greatest(F.size(ls) - n, F.lit(0))).alias("rows"))


def row_windows(tables: DataFrame, key: str, markdown: str, size: int = TABLE_ROWS) -> DataFrame:
    """(key, part, row_start, row_end, text): tables of more than size rows in windows, with the header repeated; others whole."""
    t = tables.select(key, markdown, table_rows(F.col(markdown)).alias("t")).withColumn("n", F.size("t.rows"))
    start = F.when(F.col("n") > size, F.sequence(F.lit(0), F.col("n") - 1, F.lit(size))).otherwise(F.array(F.lit(0)))
    t = t.select("*", F.posexplode(start).alias("part", "at"))
    end = F.when(F.col("n") > size, F.least(F.col("at") + size, F.col("n"))).otherwise(F.col("n"))
    body = F.when(F.col("n") > size, F.array_join(F.concat("t.header", F.slice("t.rows", F.col("at") + 1, F.lit(size))), "\n")).otherwise(F.col(markdown))
    return t.select(key, "part", (F.col("at") + 1).alias("row_start"), end.alias("row_end"), body.alias("text"))


def best_table(candidates: DataFrame, preference: tuple[str, ...] = ("vlm", "pymupdf")) -> DataFrame:
    """Of each page's tables (doc, page, source, markdown) the one with the fewest runs of blanks; ties by preference, then by name."""
    order = F.coalesce(F.array_position(F.array(*map(F.lit, preference)), F.col("source")), F.lit(0))
    order = F.when(order == 0, len(preference) + 1).otherwise(order)
    w = Window.partitionBy("doc", "page").orderBy(F.regexp_count("markdown", F.lit("  +")), order, "source")
    return candidates.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def first_occurrences(parts: DataFrame, key: str, order: str, *same: str, members: str | None = None) -> DataFrame:
    """The first of equal rows (by the columns same) of each document, with the members of all of them in order."""
    agg = [F.min(order).alias(order)]
    if members:
        agg.append(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(order, members))), lambda x: x[members])).alias(members))
    return parts.groupBy(key, *same).agg(*agg)


def finalize(parts: DataFrame, key: str, order: list[str], text: str = "text") -> DataFrame:
    """Chunk rows: chunk_index from 1 in order, a deterministic chunk_id, and the token estimate."""
    w = Window.partitionBy(key).orderBy(*order)
    p = parts.withColumn("chunk_index", F.row_number().over(w))
    return p.withColumn("chunk_id", chunk_key(F.col(key), F.col("chunk_index"), F.col(text))).withColumn("token_count", tokens(F.col(text)))


def prefix(*parts: Column) -> Column:
    """The parts that aren't null, joined by bars."""
    return F.concat_ws(" | ", *parts)


def header(label: Column, article: Column, title: Column, kind: Column) -> Column:
    """[label > 제N조(title)]; the label is left out for base terms and appendices, and without anything it is [기타]."""
    shown = F.when(~kind.isin("base", "byeolpyo"), label)
    art = F.when(article.isNotNull(), F.concat(F.lit("제"), article.cast("string"), F.lit("조"), F.coalesce(F.concat(F.lit("("), title, F.lit(")")), F.lit(""))))
    inner = F.concat_ws(" > ", shown, art)
    return F.concat(F.lit("["), F.when(inner == "", "기타").otherwise(inner), F.lit("]"))


def boilerplate(chunks: DataFrame, key: Column, order: list[str], always: Column | None = None) -> DataFrame:
    """is_boilerplate and canonical_id: all chunks with the same key but the first, and those that always are. An empty key is no key.

    Firsts are combined before they are shuffled and joined back, so a text that millions of chunks repeat is no single group.
    """
    # chunks without a key meet none; hashed by their ids they are dealt over all tasks of the join, not sent to one
    c = chunks.withColumn("__key", F.nullif(key, F.lit(""))).withColumn("__k", F.when(F.col("__key").isNull(), F.xxhash64("chunk_id")).otherwise(F.xxhash64("__key")))
    firsts = c.where("__key is not null").groupBy("__k", "__key").agg(F.min(F.struct(*[F.col(x) for x in order], F.col("chunk_id").alias("__id"))).alias("__first"), F.count("*").alias("__n")).where("__n > 1")
    c = c.join(firsts.select("__k", "__key", F.col("__first.__id").alias("__first")), ["__k", "__key"], "left")
    again = F.coalesce(F.col("__first") != F.col("chunk_id"), F.lit(False))
    c = c.withColumn("is_boilerplate", again | (F.lit(False) if always is None else always)).withColumn("canonical_id", F.when(again, F.col("__first")))
    return c.drop("__k", "__key", "__first")
