"""From pages and lines of many documents to chunk rows with a status a document: one job over all of them.

documents: doc_hash, source_pdf, doc_type (null: by the file's name), insurer, product_name and any of product_code, product_id,
effective_date, generation. pages: doc_hash, page, text, tables (array of markdown and source). lines: the lines contract, where
there are any; documents of terms without lines, or in which no boundary is found, are cut as plain text.

A document in the store is SKIPPED (or, to overwrite, replaced), one without pages is an ERROR, and any other is OK, with its chunks and
warnings. Chunks are numbered from 1 in each document; ids are made of the document, the page and the place, so that a second run gives the same.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.text import boilerplate_key, chunk_key, strip, tokens
from quarry.operators import checks, classify, scans, segment
from quarry.operators.store import delete
from quarry.session import cut

META = ["source_pdf", "insurer", "product_name", "product_code", "product_id", "effective_date", "generation"]
COLUMNS = ["doc_hash", "page_start", "page_end", "section", "section_kind", "article_no", "article_title", "chunk_type", "is_table", "header", "body", "table_source", "ord"]
LEGAL = r"(?U)법률조문\s*\|\s*용어 해설|법률조문.{0,30}용어\s*해설"


def _row(**c: Column) -> list[Column]:
    """The columns of a chunk before its document's are joined; those not given are null."""
    kind = {"page_start": "int", "page_end": "int", "article_no": "int", "is_table": "boolean", "ord": "long"}
    return [c.get(n, F.lit(None)).cast(kind.get(n, "string")).alias(n) for n in COLUMNS]


def plain_chunks(pages: DataFrame, documents: DataFrame, least: int = 10, limit: int = segment.PLAIN_LIMIT) -> DataFrame:
    """Paragraphs of a page packed up to a limit; packs of fewer tokens than least go."""
    p = pages.select(F.concat_ws("\x00", "doc_hash", F.col("page").cast("string")).alias("__k"), F.posexplode(segment.paragraphs(F.col("text"))).alias("seq", "line"))
    packs = segment.packed(p, "__k", True, limit).where(tokens(F.col("text")) >= least)
    at = F.split("__k", "\x00")
    x = packs.select(at[0].alias("doc_hash"), at[1].cast("int").alias("page"), "part", "text").join(documents.select("doc_hash", "product_name"), "doc_hash")
    return x.select(*_row(doc_hash=F.col("doc_hash"), page_start=F.col("page"), page_end=F.col("page"), section=F.col("product_name"), chunk_type=classify.plain_class(F.col("text")), is_table=F.lit(False), body=F.col("text"), ord=F.col("page").cast("long") * 1_000_000 + F.col("part")))


def schedule_chunks(pages: DataFrame, documents: DataFrame) -> DataFrame:
    """A chunk for each table that isn't blank."""
    x = pages.select("doc_hash", "page", F.posexplode("tables").alias("seq", "t")).where(F.coalesce(strip(F.col("t.markdown")), F.lit("")) != "")
    x = x.join(documents.select("doc_hash", "product_name"), "doc_hash")
    return x.select(*_row(doc_hash=F.col("doc_hash"), page_start=F.col("page"), page_end=F.col("page"), section=F.col("product_name"), chunk_type=F.lit("schedule"), is_table=F.lit(True), body=F.col("t.markdown"), table_source=F.col("t.source"), ord=F.col("page").cast("long") * 1_000_000 + F.col("seq")))


def merged_chunks(labelled: DataFrame, target: int = segment.TARGET, hard_max: int = segment.HARD_MAX, classes: Callable[[Column, Column], Column] = classify.chunk_class) -> DataFrame:
    """Labelled fragments as chunks: packs of a section's article, long lists by item, long texts by line, tables after the texts of their page, runs of bare headings as one, and of equal chunks the first."""
    w = Window.partitionBy("doc_hash").orderBy("page", "is_table", "seq", "part")
    f = labelled.withColumn("seq", F.row_number().over(w))
    text = f.where("not is_table").select("doc_hash", "seq", strip(F.col("text")).alias("line"), "section", "section_kind", "article_no", "article_title")
    packs = segment.packed(text, "doc_hash", False, target, "section", "article_no", "section_kind", "article_title")
    spans = f.where("not is_table").select("doc_hash", "seq", "page")
    ends = packs.select("doc_hash", F.col("first_seq").alias("seq"), F.lit(True).alias("__first"))
    turn = spans.join(ends, ["doc_hash", "seq"], "left").withColumn("first_seq", F.last(F.when(F.col("__first"), F.col("seq")), ignorenulls=True).over(Window.partitionBy("doc_hash").orderBy("seq")))
    turn = turn.groupBy("doc_hash", "first_seq").agg(F.min("page").alias("page_start"), F.max("page").alias("page_end"))
    packs = packs.join(turn, ["doc_hash", "first_seq"]).withColumn("chunk_type", classes(F.col("text"), F.col("section")))
    items = F.filter(segment.enumerated(F.col("text")), lambda x: strip(x) != "")
    parts = packs.withColumn("__items", items).withColumn("__parts", F.when(F.size("__items") > 1, F.col("__items")).otherwise(segment.hard_split(F.col("text"), hard_max, target)))
    parts = parts.select("*", F.posexplode("__parts").alias("__k", "body"))
    kind = ["section", "section_kind", "article_no", "article_title"]
    same = {n: F.col(n) for n in kind}
    a = parts.select(*_row(doc_hash=F.col("doc_hash"), page_start=F.col("page_start"), page_end=F.col("page_end"), chunk_type=F.col("chunk_type"), is_table=F.lit(False), body=strip(F.col("body")), ord=F.col("first_seq").cast("long") * 100_000 + F.col("__k"), **same))
    t = f.where("is_table")
    b = t.select(*_row(doc_hash=F.col("doc_hash"), page_start=F.col("page"), page_end=F.col("page"), chunk_type=classes(strip(F.col("text")), F.col("section")), is_table=F.lit(True), body=strip(F.col("text")), table_source=F.col("source") if "source" in t.columns else F.lit(None), ord=F.col("seq").cast("long") * 100_000, **same))
    u = segment.in_page_order(a.unionByName(b), "doc_hash", "ord", "page_start", "is_table").drop("ord").withColumnRenamed("place", "ord")
    u = segment.merge_titles(u).withColumn("header", segment.header(F.col("section"), F.col("article_no"), F.col("article_title"), F.col("section_kind")))
    first = Window.partitionBy("doc_hash", "header", F.md5("body"), F.length("body")).orderBy("ord")
    return u.withColumn("__r", F.row_number().over(first)).where("__r = 1").select(*COLUMNS)


def finish(chunks: DataFrame, documents: DataFrame, rows: int = segment.TABLE_ROWS) -> tuple[DataFrame, DataFrame]:
    """Chunk rows, and the large tables that were cut into windows of rows (table_id, doc_hash, page, section, source, row_count, col_count, markdown)."""
    p = segment.in_page_order(chunks, "doc_hash", "ord", "page_start", "is_table")
    t = segment.table_rows(F.col("body"))
    p = p.withColumn("__t", F.when(F.col("is_table"), t)).withColumn("__n", F.coalesce(F.size("__t.rows"), F.lit(0)))
    large = F.col("is_table") & (F.col("__n") > rows) & (F.coalesce(F.col("chunk_type"), F.lit("")) != "schedule")
    d = documents.select("doc_hash", "doc_type", *[F.col(c) if c in documents.columns else F.lit(None).cast("string").alias(c) for c in META])
    p = p.join(d, "doc_hash").withColumn("table_id", F.when(large, chunk_key(F.col("doc_hash"), F.col("page_start"), F.lit("tbl"), F.col("place"))))
    tables = p.where("table_id is not null").select("table_id", "doc_hash", F.col("page_start").alias("page"), "section", F.coalesce("table_source", F.lit("pdfplumber")).alias("source"), F.col("__n").alias("row_count"), F.greatest(F.lit(0), F.size(F.split(F.get("__t.header", F.lit(0)), r"\|")) - 2).alias("col_count"), F.col("body").alias("markdown"))
    p = p.select("*", F.posexplode(F.when(F.col("table_id").isNotNull(), F.sequence(F.lit(0), F.col("__n") - 1, F.lit(rows))).otherwise(F.array(F.lit(0)))).alias("__w", "__at"))
    whole = F.col("table_id").isNull()
    body = F.when(whole, F.col("body")).otherwise(F.array_join(F.concat("__t.header", F.slice("__t.rows", F.col("__at") + 1, F.lit(rows))), "\n"))
    art = F.when(F.col("article_no").isNotNull(), F.concat(F.lit("제"), F.col("article_no").cast("string"), F.lit("조"), F.coalesce(F.concat(F.lit("("), "article_title", F.lit(")")), F.lit(""))))
    shown = F.when(~F.coalesce("section_kind", F.lit("")).isin("base", "byeolpyo"), F.col("section"))
    prefix = segment.prefix(F.col("insurer"), F.col("product_name"), F.when(F.col("header").isNotNull(), shown), F.when(F.col("header").isNotNull(), art))
    content = F.concat_ws("\n", prefix, "header", body)
    i = F.row_number().over(Window.partitionBy("doc_hash").orderBy("place", "__w"))
    c = p.withColumn("chunk_index", i).withColumn("content", content).withColumn("token_count", tokens(content)).withColumn("row_start", F.when(~whole, F.col("__at") + 1)).withColumn("row_end", F.when(~whole, F.least(F.col("__at") + rows, F.col("__n"))))
    c = c.withColumn("chunk_id", chunk_key(F.col("doc_hash"), F.col("source_pdf"), F.col("page_start"), F.coalesce(F.concat(F.lit("tbl:"), "table_id", F.lit(":"), F.col("row_start").cast("string")), F.col("place").cast("string"))))
    keep = ["chunk_id", "doc_hash", "doc_type", *META, "page_start", "page_end", "section", "section_kind", "article_no", "article_title", "chunk_index", "chunk_type", "content", "token_count", "is_table", "table_id", "row_start", "row_end"]
    return c.select(*keep), tables


def chunk(documents: DataFrame, pages: DataFrame, lines: DataFrame | None = None, target: int = segment.TARGET, hard_max: int = segment.HARD_MAX) -> tuple[DataFrame, DataFrame]:
    """Chunk rows and large tables of documents, by their type."""
    d = documents.withColumn("doc_type", F.coalesce("doc_type", classify.document_type(F.col("source_pdf"))))
    kind = lambda p: pages.join(d.where(p).select("doc_hash"), "doc_hash", "left_semi")
    parts = [schedule_chunks(kind("doc_type = 'schedule'"), d)]
    if lines is None:
        plain = kind("doc_type <> 'schedule'")
    else:
        of_terms = lines.join(d.where("doc_type = 'policy_terms'").select("doc_hash"), "doc_hash", "left_semi")
        bounds = cut(scans.boundaries(of_terms), "bounds")
        known = bounds.select("doc_hash").distinct()
        plain = segment.front_matter(kind("doc_type <> 'schedule'").join(known, "doc_hash", "left_anti"), scans.detect(of_terms))
        body = segment.front_matter(kind("doc_type = 'policy_terms'").join(known, "doc_hash", "left_semi"), scans.detect(of_terms))
        fragments = segment.fragments(body.withColumnRenamed("doc_hash", "doc"))
        cuts = fragments.where("not is_table").select("doc", "page", "seq", F.posexplode(segment.article_parts(F.col("text"))).alias("k", "text"))
        text = cuts.select("doc", "page", F.lit(False).alias("is_table"), F.row_number().over(Window.partitionBy("doc", "page").orderBy("seq", "k")).alias("seq"), "text", F.lit(None).cast("string").alias("source"))
        fragments = cut(text.unionByName(fragments.where("is_table")).withColumnRenamed("doc", "doc_hash"), "fragments")
        labelled = scans.label_articles(fragments.drop("source"), bounds, scans.contents(of_terms))
        labelled = labelled.join(fragments.where("is_table").select("doc_hash", "page", "is_table", "seq", "source"), ["doc_hash", "page", "is_table", "seq"], "left")
        parts.append(merged_chunks(cut(labelled, "labelled"), target, hard_max))
    parts.append(plain_chunks(plain, d))
    u = parts[0]
    for x in parts[1:]:
        u = u.unionByName(x)
    chunks, tables = finish(cut(u, "parts"), d)
    marked = segment.boilerplate(chunks, F.when(F.col("doc_type") == "policy_terms", F.concat_ws("\x00", "doc_hash", F.nullif(boilerplate_key(F.col("content")), F.lit("")))), ["chunk_index"], F.rlike(F.substring("content", 1, 300), F.lit(LEGAL)))
    return marked, tables


def ingest(documents: DataFrame, pages: DataFrame, lines: DataFrame | None = None, store: DataFrame | None = None, overwrite: bool = False, **sizes: int) -> dict[str, DataFrame]:
    """chunks (valid ones), tables, issues and status (doc_hash, source_pdf, status, reason, chunks, warnings) of all documents; with a store, also its next snapshot.

    The store holds the columns of chunks; a document that it has is left out before anything is read, or replaced if overwrite is set.
    """
    known = None if store is None else store.select("doc_hash").distinct()
    new = documents if known is None or overwrite else documents.join(known, "doc_hash", "left_anti")
    ready = new.join(pages.select("doc_hash").distinct(), "doc_hash", "left_semi")
    every, tables = chunk(ready, pages.join(ready.select("doc_hash"), "doc_hash", "left_semi"), lines, **sizes)
    every = cut(every, "chunks")
    valid, issues = checks.validate(every, "insurer", "product_name", "section")
    n = valid.groupBy("doc_hash").agg(F.count("*").alias("chunks"))
    warned = issues.where(~F.col("issue").isin("blank", "tiny")).join(every.select("chunk_id", "doc_hash"), "chunk_id").groupBy("doc_hash").agg(F.count("*").alias("warnings"))
    seen = documents.select("doc_hash", "source_pdf")
    seen = seen.join(new.select("doc_hash", F.lit(True).alias("__new")), "doc_hash", "left").join(ready.select("doc_hash", F.lit(True).alias("__ready")), "doc_hash", "left").join(n, "doc_hash", "left").join(warned, "doc_hash", "left")
    status = F.when(F.col("__new").isNull(), "SKIPPED").when(F.col("__ready").isNull(), "ERROR").otherwise("OK")
    why = F.when(F.col("__new").isNull(), "already ingested").when(F.col("__ready").isNull(), "no pages")
    out = {"chunks": valid, "tables": tables, "issues": issues, "status": seen.select("doc_hash", "source_pdf", status.alias("status"), why.alias("reason"), F.coalesce("chunks", F.lit(0)).alias("chunks"), F.coalesce("warnings", F.lit(0)).alias("warnings"))}
    if store is not None:
        rest = delete(store, ready, "doc_hash") if overwrite else store
        out["store"] = rest.unionByName(valid.select(*[c for c in rest.columns if c in valid.columns]), allowMissingColumns=True)
    return out


def failed(status: DataFrame) -> bool:
    """Whether any document is an ERROR: what a batch's exit code tells."""
    return not status.where("status = 'ERROR'").isEmpty()
