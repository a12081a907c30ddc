"""Declared row types; readers check what they read against them."""

from __future__ import annotations

from pyspark.sql import DataFrame

LINES = "doc_hash string, page int, block_no int, line_no int, text string, font_size double, is_bold boolean, is_isolated boolean, x0 double, y0 double, x1 double, y1 double"
TABLE_BOXES = "doc_hash string, page int, table_no int, x0 double, y0 double, x1 double, y1 double, source string, markdown string"
PAGES = "doc_hash string, page int, text string, tables array<struct<markdown:string,source:string>>, is_ocr boolean"
CHUNKS = "chunk_id string, doc_hash string, doc_type string, insurer string, product_name string, product_code string, product_id string, effective_date date, page_start int, page_end int, section string, section_kind string, article_no int, article_title string, chunk_index int, chunk_type string, content string, token_count int, is_table boolean, table_id string, row_start int, row_end int, embedding array<float>, is_boilerplate boolean, canonical_id string, ingested_at timestamp"
QUESTIONS = "qid string, qtype string, question string, gold array<struct<section:string,article:string>>, keywords array<string>"
MANIFEST = "pdf string, insurer string, product_name string, product_code string, effective_date string, generation string, doc_type string, product_id string"


def conform(df: DataFrame, schema: str) -> DataFrame:
    """df with exactly the columns of schema, by name, cast to its types; a column that is missing is an error."""
    want = df.sparkSession.createDataFrame([], schema).schema
    missing = [f.name for f in want if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in want])
