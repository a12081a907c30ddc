"""Hit tests and retrieval metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hit(section: Column, article: Column, content: Column, gold: Column, keywords: Column, strict: bool = True) -> Column:
    """Whether a chunk answers: a gold pair of its section and article; for gold without an article (a table) the section and any keyword; not strict: the section and any keyword are enough for either."""
    word = F.exists(F.coalesce(keywords, F.array().cast("array<string>")), lambda k: F.contains(content, k))
    table = lambda g: g["article"].isNull() & (g["section"] == section) & word
    clause = lambda g: g["article"].isNotNull() & (g["section"] == section) & ((F.lit(not strict) & F.coalesce(word, F.lit(False))) | F.coalesce(g["article"] == article, F.lit(False)))
    return F.coalesce(F.exists(gold, lambda g: F.coalesce(table(g) | clause(g), F.lit(False))), F.lit(False))


def per_query(ranked: DataFrame, *by: str, hit_column: str = "hit") -> DataFrame:
    """Recall at 1 and 5, and the reciprocal rank within 10, of each query."""
    h = F.col(hit_column)
    first = F.min(F.when(h & (F.col("rank") <= 10), F.col("rank")))
    return ranked.groupBy(*by).agg(
        F.max((h & (F.col("rank") <= 1)).cast("int")).cast("double").alias("r1"), F.max((h & (F.col("rank") <= 5)).cast("int")).cast("double").alias("r5"), F.coalesce(F.lit(1.0) / first, F.lit(0.0)).alias("rr")
    )


def means(scores: DataFrame, *by: str) -> DataFrame:
    return scores.groupBy(*by).agg(F.count("*").alias("n"), *[F.round(F.avg(c), 6).alias(c) for c in ("r1", "r5", "rr")])


def pivot(scores: DataFrame, by: str, column: str, values: list, measure: str = "r5") -> DataFrame:
    """Mean measure by a row for each by and a column for each value; the values are named, so there is no extra pass to find them."""
    return scores.groupBy(by).pivot(column, values).agg(F.round(F.avg(measure), 6))


def precision_recall(found: DataFrame, truth: DataFrame, key: str) -> DataFrame:
    """One row: sizes, precision and recall of two sets of keys."""
    a, b = found.select(key).distinct(), truth.select(key).distinct()
    both = a.withColumn("f", F.lit(1)).join(b.withColumn("t", F.lit(1)), key, "full_outer")
    c = both.agg(F.count("f").alias("found"), F.count("t").alias("truth"), F.count_if(F.col("f").isNotNull() & F.col("t").isNotNull()).alias("both"))
    return c.select("*", F.round(F.try_divide(F.col("both"), F.col("found")), 6).alias("precision"), F.round(F.try_divide(F.col("both"), F.col("truth")), 6).alias("recall"))


def agreement(pred: DataFrame, other: DataFrame, key: str, a: str, b: str) -> DataFrame:
    """One row: rows in both, and the share in which the labels are the same."""
    return pred.join(other, key).agg(F.count("*").alias("n"), F.round(F.avg((F.col(a) == F.col(b)).cast("double")), 6).alias("agreement"))


def accuracy(predictions: DataFrame, gold: DataFrame, key: str, label: str = "gold", predicted: str = "predicted", seconds: str | None = None, *by: str) -> DataFrame:
    """(by, n, accuracy, latency): share of predictions that are the gold label, and their mean time. A missing prediction is wrong."""
    j = gold.select(key, label).join(predictions, key)
    right = F.coalesce(F.col(predicted) == F.col(label), F.lit(False)).cast("double")
    return j.groupBy(*by).agg(F.count("*").alias("n"), F.round(F.avg(right), 6).alias("accuracy"), F.round(F.avg(seconds), 6).alias("latency") if seconds else F.lit(None).cast("double").alias("latency"))


def reachability(chunks: DataFrame, questions: DataFrame) -> DataFrame:
    """(qid, strict, lenient): how many chunks (section, article, content) answer each question (qid, gold, keywords). Chunks and questions meet by section, so none is compared with all."""
    g = questions.select("qid", "gold", "keywords", F.explode(F.array_distinct(F.transform("gold", lambda x: x["section"]))).alias("section"))
    j = g.join(chunks.select("section", "article", "content"), "section")
    c = [F.col(n) for n in ("section", "article", "content", "gold", "keywords")]
    n = j.groupBy("qid").agg(F.count_if(hit(*c)).alias("strict"), F.count_if(hit(*c, strict=False)).alias("lenient"))
    return questions.select("qid").join(n, "qid", "left").select("qid", F.coalesce("strict", F.lit(0)).alias("strict"), F.coalesce("lenient", F.lit(0)).alias("lenient"))


def grid(rows: DataFrame, **dimensions: list) -> DataFrame:
    """rows once for each combination of the values of some small dimensions, one column each."""
    for name, values in dimensions.items():
        rows = rows.withColumn(name, F.explode(F.array(*map(F.lit, values))))
    return rows


def against(scores: DataFrame, column: str, base: str, *by: str, measure: str = "r5") -> DataFrame:
    """scores with delta: the measure less that of the row of the same by whose column is base; 0 where there is none."""
    b = scores.where(F.col(column) == base).select(*by, F.col(measure).alias("__b"))
    return scores.join(b, list(by), "left").withColumn("delta", F.round(F.col(measure) - F.coalesce("__b", measure), 6)).drop("__b")


def report(table: DataFrame, title: str, order: list[str], most: int = 10_000) -> str:
    """A small table as Markdown, in order. A table of more than most rows is no report, and an error."""
    rows = table.orderBy(*order).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a report has at most {most} rows")
    show = lambda v: "" if v is None else f"{v:.3f}" if isinstance(v, float) else str(v).replace("|", "／").replace("\n", " ")
    lines = [f"# {title}", "", "| " + " | ".join(table.columns) + " |", "|" + "---|" * len(table.columns)]
    return "\n".join([*lines, *("| " + " | ".join(map(show, r)) + " |" for r in rows)]) + "\n"
