"""Sources: files of lines, tables, questions and manifests; binary objects; candidates of several extractors as one table."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import needs
from quarry.sources.schemas import MANIFEST, QUESTIONS, conform


def jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a file of JSON lines; blank lines are left out."""
    return spark.read.text(path).where(F.trim("value") != "").select(F.from_json("value", schema).alias("r")).select("r.*")


def questions(spark: SparkSession, path: str) -> DataFrame:
    return jsonl(spark, path, QUESTIONS)


def binary(spark: SparkSession, path: str, done: DataFrame | None = None) -> DataFrame:
    """(path, doc_hash, content) of files; those whose digest is in done (doc_hash) are left out. Column pruning keeps content out of plans that don't use it."""
    f = spark.read.format("binaryFile").load(path).select("path", F.sha2("content", 256).alias("doc_hash"), "content")
    return f if done is None else f.join(done.select("doc_hash").distinct(), "doc_hash", "left_anti")


def manifest(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Documents of a manifest that has been parsed; none, or one without pdf, insurer or product_name, is an error."""
    names = [c.split()[0] for c in MANIFEST.split(", ")]
    if not rows:
        raise ValueError("the manifest has no documents")
    for r in rows:
        if any(not r.get(k) for k in names[:3]):
            raise ValueError(f"pdf, insurer and product_name are needed: {r}")
    return spark.createDataFrame([tuple(None if r.get(n) is None else str(r[n]) for n in names) for r in rows], MANIFEST).withColumn("effective_date", F.try_to_date("effective_date", "yyyy-MM-dd"))


def manifest_rows(text: str) -> list[dict]:
    """The list under documents: of a manifest in YAML: with a YAML module where there is one, else of plain keys and values."""
    yaml = needs("yaml", fallback=False)
    if yaml:
        return (yaml.safe_load(text) or {}).get("documents") or []
    out: list[dict] = []
    inside = False
    for line in (x.split(" #")[0].rstrip() for x in text.splitlines()):
        if not line.strip() or line.lstrip().startswith("#"):
            continue
        if not line.startswith((" ", "-")):
            inside = line.strip() == "documents:"
        elif inside:
            if line.lstrip().startswith("- "):
                out.append({})
            k, _, v = line.strip().removeprefix("- ").partition(":")
            v = v.strip().strip("'\"")
            out[-1][k.strip()] = None if v in ("", "null", "~") else v
    return out


def manifest_file(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a manifest file in YAML."""
    return manifest(spark, manifest_rows("\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())))


def table_candidates(*sources: tuple[str, DataFrame]) -> DataFrame:
    """Tables of several extractors (doc, page, markdown) with their names; those of all but the first are taken only for pages where the first found one."""
    named = [df.select("doc", "page", F.lit(n).alias("source"), "markdown") for n, df in sources]
    ruled = named[0].select("doc", "page").distinct()
    rest = [d.join(ruled, ["doc", "page"], "left_semi") for d in named[1:]]
    return functools.reduce(DataFrame.unionByName, rest, named[0])


def with_tables(pages: DataFrame, best: DataFrame) -> DataFrame:
    """pages (doc, page, text) with the best table of each, or none."""
    t = best.select("doc", "page", F.array(F.struct("markdown", "source")).alias("tables"))
    return pages.join(t, ["doc", "page"], "left").withColumn("tables", F.coalesce("tables", F.array().cast("array<struct<markdown:string,source:string>>")))


def page_base(pages: DataFrame, results: DataFrame) -> DataFrame:
    """results (doc, page) with pages numbered like those asked for: as they are, from 0, or by position, whichever gives the same set."""
    a = pages.groupBy("doc").agg(F.array_sort(F.collect_set("page")).alias("asked"))
    r = results.groupBy("doc").agg(F.array_sort(F.collect_set("page")).alias("got"))
    same = lambda x, y: (F.size(F.array_except(x, y)) == 0) & (F.size(F.array_except(y, x)) == 0)
    up = F.transform("got", lambda p: p + 1)
    to = F.when(same(F.col("got"), F.col("asked")), F.col("got")).when(same(up, F.col("asked")), up).otherwise(F.slice("asked", 1, F.size("got")))
    m = a.join(r, "doc").select("doc", F.explode(F.map_from_arrays(F.slice("got", 1, F.size(to)), F.slice(to, 1, F.size("got")))).alias("page", "to"))
    return results.join(m, ["doc", "page"]).withColumn("page", F.col("to")).drop("to")


__all__ = ["binary", "conform", "jsonl", "manifest", "page_base", "questions", "table_candidates", "with_tables"]
