"""Models from outside as functions of a batch of texts: answers in JSON, judgements, embeddings and rewritten queries.

A model is a plain function that takes a list of texts and gives a list of as many answers. It runs in the tasks, a batch of Arrow rows at a time;
one that fails is tried again, and after that its rows are null and don't stop the others. Answers are kept with sinks.append_new(),
which asks only for what a cache doesn't have.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.pyfuncs import similarity, udf
from quarry.functions.text import body_of, dense
from quarry.session import ship_package

Model = Callable[[list[str]], list]
PERSONAS = ("policyholder", "relative", "agent", "claims")
ABSORB = 0.8


def parsed(answer: str | None, required: tuple[str, ...] = ()) -> dict | None:
    """The object in an answer, perhaps fenced, if it has the required fields."""
    try:
        out = json.loads(re.sub(r"^```(?:json)?|```$", "", answer or "", flags=re.M).strip())
    except ValueError:
        return None
    return out if isinstance(out, dict) and all(k in out for k in required) else None


def ask(rows: DataFrame, key: str, prompt: Column, model: Model, required: tuple[str, ...] = (), tries: int = 3, wait: float = 0.0, size: int = 32) -> DataFrame:
    """(key, answer): answers as JSON texts if there are required fields (null where an answer hasn't them), else as they are; null prompts aren't asked."""
    ship_package(rows.sparkSession)

    def once(texts: list[str]) -> list:
        for i in range(tries):
            try:
                got = model(texts)
                if len(got) != len(texts):
                    raise ValueError(f"{len(got)} answers to {len(texts)} texts")
                return got
            except Exception:  # the model's own failures, of any kind
                time.sleep(wait * (i + 1))
        return [None] * len(texts) if len(texts) == 1 else [a for t in texts for a in once([t])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, answers = batch.column(1).to_pylist(), []
            for i in range(0, len(texts), size):
                part = [t for t in texts[i : i + size] if t is not None]
                got = iter(once(part) if part else [])
                answers += [None if t is None else next(got) for t in texts[i : i + size]]
            if required:
                objects = [parsed(a, required) for a in answers]
                answers = [None if o is None else json.dumps(o, ensure_ascii=False) for o in objects]
            yield pa.record_batch({key: batch.column(0), "answer": pa.array([None if a is None else str(a) for a in answers], pa.string())})

    t = rows.select(key, prompt.cast("string").alias("__p"))
    return t.mapInArrow(run, f"`{key}` {t.schema[key].dataType.simpleString()}, answer string")


def embed(rows: DataFrame, key: str, text: str, model: Model, dimension: int, skip: Column | None = None, prefix: str = "", most: int = 1800, size: int = 32) -> DataFrame:
    """(key, embedding): vectors of texts, of most characters each, with a prefix (queries have one, documents none); rows to skip have none. Another dimension, or another number of vectors, is an error."""
    ship_package(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, out = batch.column(1).to_pylist(), []
            for i in range(0, len(texts), size):
                part = [t for t in texts[i : i + size] if t is not None]
                got = [[float(x) for x in v] for v in (model(part) if part else [])]
                if len(got) != len(part) or any(len(v) != dimension for v in got):
                    raise ValueError(f"{len(part)} vectors of {dimension} numbers were asked for")
                vectors = iter(got)
                out += [None if t is None else next(vectors) for t in texts[i : i + size]]
            yield pa.record_batch({key: batch.column(0), "embedding": pa.array(out, pa.list_(pa.float32()))})

    full = F.concat(F.lit(prefix), F.when(F.coalesce(F.col(text), F.lit("")) == "", " ").otherwise(F.substring(text, 1, most)))
    t = rows.select(key, (full if skip is None else F.when(~F.coalesce(skip, F.lit(False)), full)).alias("__t"))
    return t.mapInArrow(run, f"`{key}` {t.schema[key].dataType.simpleString()}, embedding array<float>")


def persona(key: Column, seed: int, personas: tuple[str, ...] = PERSONAS) -> Column:
    """Who asks about a chunk: drawn by a hash of the seed and its key, so a second run draws the same."""
    return F.get(F.array(*map(F.lit, personas)), F.pmod(F.xxhash64(F.lit(seed), key), F.lit(len(personas))).cast("int"))


def question_prompt(section: Column, article: Column, title: Column, content: Column, who: Column, n: int = 2) -> Column:
    """What a model is asked for questions about a chunk: where it stands, 2,000 characters of its body, who asks, and how many."""
    return F.concat_ws("\n", F.concat(F.lit("[section] "), F.coalesce(section, F.lit(""))), F.concat_ws(" ", F.lit("[article]"), article, title), F.lit("[text]"), F.substring(body_of(content), 1, 2000), F.concat(F.lit("[asked by] "), who), F.lit(f"[questions] {n}"))


def questions_of(answers: DataFrame, key: str) -> DataFrame:
    """(key, qtype, question, answer_span, keywords): a row for each question in a model's answers that has a text."""
    kind = "struct<questions:array<struct<qtype:string,question:string,answer_span:string,keywords:array<string>>>>"
    q = answers.select(key, F.explode(F.from_json("answer", kind)["questions"]).alias("q"))
    return q.where(F.coalesce(F.col("q.question"), F.lit("")) != "").select(key, "q.*")


def judge(pairs: DataFrame, key: str, question: Column, content: Column, model: Model, **how) -> DataFrame:
    """(key, answerable): whether a model finds that a text, of 1,800 characters, answers a question; null where it has no answer."""
    prompt = F.concat(F.lit("[text]\n"), F.substring(content, 1, 1800), F.lit("\n\n[question] "), question)
    a = ask(pairs, key, prompt, model, ("answerable",), **how)
    return a.select(key, F.get_json_object("answer", "$.answerable").cast("boolean").alias("answerable"))


def judged(questions: DataFrame) -> DataFrame:
    """Questions with verdict: judge_pos (its own text doesn't answer), kept, judge_neg (another text does, too), or absorbed, where that text is the same clause under the same title.

    questions: qid, pos, neg, title, content, other_title, other_content, and gold and other_gold (section and article).
    An absorbed text's section and article are in gold afterwards.
    """
    same = udf(similarity)(dense(body_of(F.col("content"))), dense(body_of(F.col("other_content"))))
    answers_too = F.coalesce("neg", F.lit(False))
    q = questions.withColumn("similarity", F.round(F.when(answers_too & F.col("title").eqNullSafe(F.col("other_title")) & F.col("title").isNotNull(), same), 2))
    verdict = F.when(~F.coalesce("pos", F.lit(False)), "judge_pos").when(~answers_too, "kept").when(F.col("similarity") >= ABSORB, "absorbed").otherwise("judge_neg")
    q = q.withColumn("verdict", verdict)
    return q.withColumn("gold", F.when(F.col("verdict") == "absorbed", F.array_sort(F.array_union("gold", F.array("other_gold")))).otherwise(F.col("gold")))


def extraction_benchmark(results: DataFrame) -> DataFrame:
    """(policy, backend, pages, found, seconds): of timed runs of extractors, one row a page, how many pages gave a table, and the mean time a page."""
    return results.groupBy("policy", "backend").agg(F.count("*").alias("pages"), F.count_if(F.coalesce(F.trim("markdown"), F.lit("")) != "").alias("found"), F.round(F.avg("sec_per_page"), 3).alias("seconds"))
