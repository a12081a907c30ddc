import random
import sys
import threading

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.operators import catalogue, contain, evaluation, questions, retrieval, store, terms
from quarry.sources import readers, schemas, sinks
from quarry.streaming import ingest


def test_fusion_and_citations(spark):
    rank = lambda *ids: spark.createDataFrame([(1, i, k + 1) for k, i in enumerate(ids)], "qid int, id string, rank int")
    r = retrieval.fuse(rank("t1", "t2"), rank("t2", "t3"), weights=(0.5, 0.5))
    got = [(x.id, x.score) for x in r.orderBy("rank").collect()]
    assert [g[0] for g in got] == ["t2", "t1", "t3"] and abs(got[0][1] - (0.5 / 62 + 0.5 / 61)) < 1e-8
    meta = spark.createDataFrame([("t1", "제3조", "특약A"), ("t2", "제5조", None), ("t3", "제7조", None)], "id string, clause_no string, exhibit string")
    c = retrieval.citations(r.join(meta, "id")).orderBy("ordinal").collect()
    assert [(x.clause_no, x.exhibit) for x in c] == [("제5조", None), ("제3조", "특약A"), ("제7조", None)]
    s = spark.createDataFrame([(1, "t3", 9.0), (1, "t1", 5.0)], "qid int, id string, rerank_score double")
    assert [x.id for x in retrieval.rerank(r, s, head=2).orderBy("rank").collect()] == ["t1", "t2", "t3"]


def test_router_and_search(spark):
    q = spark.createDataFrame([(1, "자동차 사고 보장", [1.0, 0.0]), (2, "골절 보장", [1.0, 0.0]), (3, None, None)], "qid int, text string, embedding array<double>")
    assert sorted(r.qid for r in retrieval.in_scope(q, "text").collect()) == [2, 3]
    c = spark.createDataFrame([(10, "골절 보장 내용", [0.0, 1.0], "제1조", None), (11, "다른 글", [1.0, 0.1], "제2조", None), (12, "빈 글", None, None, None)], "id long, text string, embedding array<double>, clause_no string, exhibit string")
    got = [(r.qid, r.id) for r in retrieval.search(c, q).orderBy("qid", "rank").collect()]
    assert got == [(2, 10), (2, 11)]
    swap = lambda rows: rows.select("qid", "id", (F.col("id") * 1.0).alias("rerank_score"))
    assert [r.id for r in retrieval.search(c, q, reranker=swap).orderBy("rank").collect()] == [11, 10]


def test_repeated_query_words_count_again(spark):
    d = spark.createDataFrame([(1, "a b"), (2, "c c"), (3, "")], "doc_id long, text string")
    q = spark.createDataFrame([(1, "a a"), (2, "a"), (3, "a c"), (4, " ")], "item_id long, text string")
    s = {(r.item_id, r.doc_id): r.score for r in retrieval.bm25(d, q).collect()}
    assert abs(s[1, 1] - 2 * s[2, 1]) < 1e-5 and (3, 2) in s and not any(k[0] == 4 for k in s)
    assert {(r.item_id, r.doc_id) for r in retrieval.bm25(d, q, every=True).collect()} == {(1, 1), (2, 1)}


def test_a_query_meets_only_documents_with_its_rarest_word(spark):
    d = spark.createDataFrame([(i, f"a b c {i % 3}x" if i else "a b rare c 0x") for i in range(60)], "doc_id long, text string")
    q = spark.createDataFrame([(1, "a b c rare"), (2, "rare c b a"), (3, "a rare none"), (4, "a a b"), (5, "1x a")], "item_id long, text string")
    got = {}
    for r in retrieval.bm25(d, q, every=True, k=None).collect():
        got.setdefault(r.item_id, set()).add(r.doc_id)
    assert got == {1: {0}, 2: {0}, 4: set(range(60)), 5: {i for i in range(60) if i % 3 == 1}}
    plan = retrieval.bm25(d, q, every=True)._jdf.queryExecution().executedPlan().toString()
    assert "min_by(term" not in plan and "needed" in plan
    one = {(r.doc_id, r.score, r["rank"]) for r in retrieval.bm25(d, q, every=True, k=5).where("item_id = 1").collect()}
    assert one == {(r.doc_id, r.score, r["rank"]) for r in retrieval.bm25(d, q, every=True, k=5).where("item_id = 2").collect()}


def test_hits_and_metrics(spark):
    gold = "array<struct<section:string,article:string>>"
    rows = [("s", "1", "x", [("s", "1")], None), ("s", "2", "x", [("s", "1")], None), ("s", None, "a key", [("s", None)], ["key"]), ("s", None, "a", [("s", None)], ["key"]), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, f"section string, article string, content string, gold {gold}, keywords array<string>")
    h = lambda strict: [r[0] for r in df.select(evaluation.hit(*map(F.col, ("section", "article", "content", "gold", "keywords")), strict=strict)).collect()]
    assert h(True) == [True, False, True, False, False] and h(False) == [True, False, True, False, False]
    wide = df.limit(0).unionByName(spark.createDataFrame([("s", "2", "a key", [("s", "1")], ["key"])], df.schema))
    assert [wide.select(evaluation.hit(*map(F.col, wide.columns), strict=x)).first()[0] for x in (True, False)] == [False, True]
    counts = evaluation.reachability(df.select("section", "article", "content"), wide.select(F.lit("q").alias("qid"), "gold", "keywords")).first()
    assert (counts.strict, counts.lenient) == (1, 2)
    r = spark.createDataFrame([("q", 1, False), ("q", 4, True), ("p", 12, True)], "qid string, rank int, hit boolean")
    assert {(x.qid, x.r1, x.r5, x.rr) for x in evaluation.per_query(r, "qid").collect()} == {("q", 0.0, 1.0, 0.25), ("p", 0.0, 0.0, 0.0)}
    e = evaluation.precision_recall(r.limit(0), r, "qid").first()
    assert e["precision"] is None and e["recall"] == 0.0


def test_store(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, doc string, v string")
    new = spark.createDataFrame([(2, "B", None), (3, "C", "z")], "k int, doc string, v string")
    assert sorted(map(tuple, store.upsert(old, new, "k", ["doc"]).collect())) == [(1, "a", "x"), (2, "b", None), (3, "C", "z")]
    again = store.upsert(store.upsert(old, new, "k", ["doc"]), new, "k", ["doc"])
    assert again.count() == 3
    rows = spark.createDataFrame([(1, 5), (2, 15), (3, 35), (4, 10)], "id int, at int")
    b = spark.createDataFrame([(10, 1, "p"), (10, 2, "q"), (20, 3, None)], "at int, ord int, label string")
    for bucket in (None, F.floor(F.col("at") / 10)):
        got = {r.id: (r.ord, r.label) for r in store.as_of(rows, b, "at", "ord", ["ord", "label"], bucket=bucket).collect()}
        assert got == {1: (None, None), 2: (2, "q"), 3: (3, None), 4: (2, "q")}


def test_catalogue(spark):
    f = spark.createDataFrame([("p1", None, 1), ("p2", False, 9), ("p3", True, None)], "page_id string, is_latest boolean, priority int")
    p = spark.createDataFrame([("p1", 2, "h"), ("p1", 1, None), ("p3", 1, "g"), ("p2", 1, "z")], "page_id string, part_order int, sha256 string")
    rows = catalogue.join(f, p)
    assert [(r.page_id, r.part_order) for r in rows.collect()] == [("p3", 1), ("p1", 1), ("p1", 2)]
    done = spark.createDataFrame([("g",)], "doc_hash string")
    assert sorted((r.sha256 or "") for r in catalogue.pending(rows, done).collect()) == ["", "h"]


def test_questions(spark):
    c = spark.createDataFrame([(str(i), "t" if i % 3 else "u", f"text {i // 2}") for i in range(12)], "chunk_id string, chunk_type string, content string")
    got = questions.candidates(c, 4).collect()
    assert len(got) == 4 and len({r.content for r in got}) == 4 and {r.chunk_type for r in got} == {"t", "u"}
    v = spark.createDataFrame([("g", 1, [1.0, 0.0]), ("g", 2, [1.0, 0.01]), ("g", 3, [0.0, 1.0])], "group string, ord int, embedding array<double>")
    assert sorted(r.ord for r in questions.accept_apart(v).collect()) == [1, 3]


def test_sources_and_sinks(spark, tmp_path):
    p = tmp_path / "q.jsonl"
    p.write_text('{"qid": "1", "gold": [{"section": "s", "article": null}]}\n\n{"qid": "2"}\n')
    assert [r.qid for r in readers.questions(spark, str(p)).collect()] == ["1", "2"]
    for bad in ([], [{"pdf": "a"}]):
        try:
            readers.manifest(spark, bad)
            raise AssertionError
        except ValueError:
            pass
    assert readers.manifest(spark, [{"pdf": "a", "insurer": "b", "product_name": "c", "effective_date": "2024-02-30"}]).first().effective_date is None
    pages = spark.createDataFrame([("d", 3), ("d", 4)], "doc string, page int")
    assert sorted(r.page for r in readers.page_base(pages, spark.createDataFrame([("d", 2), ("d", 3)], "doc string, page int")).collect()) == [3, 4]
    c = spark.createDataFrame([("claim", 10), ("claim", 700), ("general", 20)], "chunk_type string, token_count int")
    s = sinks.summary(c).first()
    assert (s.chunks, s["min"], s["max"], s.over_600, s.types) == (3, 10, 700, 1, {"claim": 2, "general": 1})
    try:
        schemas.conform(c, "missing int")
        raise AssertionError
    except ValueError:
        pass


def test_polling_is_idempotent(spark, tmp_path):
    src, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    schema = "doc_hash string, chunk_id string, content string"
    rows = spark.createDataFrame([("a", "1", "x y"), ("a", "2", "w"), ("b", "3", "z"), ("a", "1", "x y")], schema)
    rows.write.parquet(src)
    ingest.poll(spark, src, schema, out, cp).awaitTermination()
    rows.unionByName(spark.createDataFrame([("c", "4", "new words")], schema)).write.mode("append").parquet(src)
    ingest.poll(spark, src, schema, out, cp).awaitTermination()
    store = spark.read.parquet(out)
    assert sorted((r.doc_hash, r.chunk_id) for r in store.collect()) == [("a", "1"), ("a", "2"), ("b", "3"), ("c", "4")]
    t = str(tmp_path / "terms")
    assert ingest.rebuild_terms(store.where("batch = 0"), t) == {"extracted": 0, "inserted": 0, "total": 0, "skipped": False}
    assert ingest.rebuild_terms(store, t) == {"extracted": 2, "inserted": 2, "total": 2, "skipped": False}
    with ingest.lock(spark, t + ".lock") as mine:
        assert mine and ingest.rebuild_terms(store, t)["skipped"]
    assert ingest.rebuild_terms(store, t)["inserted"] == 0
    x = terms.trigram_similar(spark.createDataFrame([("hello",), ("world",)], "term string"), spark.createDataFrame([("helo",)], "term string")).collect()
    assert [(r.word, r.term) for r in x] == [("helo", "hello")]


def test_turns(spark):
    done = []
    assert ingest.cycle(lambda: True, lambda: done.append(1)) == "done" and ingest.cycle(lambda: False, lambda: done.append(2)) == "failed"
    assert ingest.cycle(lambda: 1 / 0, lambda: done.append(3)).startswith("failed") and done == [1]
    stop = threading.Event()
    turns = []

    def turn():
        turns.append(1)
        if len(turns) == 2:
            stop.set()

    assert ingest.run_forever(turn, 0.01, stop=stop) == 2


def test_vectors_against_all_pairs(spark):
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(size=(300, 8)), 1)
    x[7] = x[8] = x[9]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(400, None), (401, [0.0] * 8), (None, [1.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = np.round(u @ u.T, 6)
    for drop in (False, True):
        want = []
        for q in range(300):
            order = sorted((k for k in range(300) if not (drop and k == q)), key=lambda k: (-s[q, k], k))[:7]
            want += [(q, k, r + 1) for r, k in enumerate(order)]
        got = retrieval.vectors(df, df.withColumnRenamed("vec_id", "qid"), k=7, drop_self=drop, block=50, slice_bytes=4000)
        assert sorted((r.qid, r.vec_id, r["rank"]) for r in got.collect()) == sorted(want)
        assert "CartesianProduct" not in got._jdf.queryExecution().toString() and "NestedLoop" not in got._jdf.queryExecution().toString()
    assert retrieval.vectors(df.limit(0), df.withColumnRenamed("vec_id", "qid")).count() == 0
    named = df.withColumn("vec_id", F.concat(F.lit("c"), F.col("vec_id").cast("string")))
    assert retrieval.vectors(named, df.withColumnRenamed("vec_id", "qid"), k=1).where("qid = 3").first().vec_id == "c3"


def test_vectors_of_one_file_are_dealt_over_the_cores_and_ties_stay_in_order(spark):
    rows = [(i, [1.0, 0.0] if i % 2 else [1.0, 0.001 * (i // 40)]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1)
    got = retrieval.vectors(df, df.where("vec_id % 20 = 0").withColumnRenamed("vec_id", "qid"), k=9, drop_self=True, block=32)
    assert "SinglePartition" not in got._jdf.queryExecution().toString() and "hashpartitioning(k#" in got._jdf.queryExecution().executedPlan().toString()
    assert [r.vec_id for r in got.where("qid = 0").orderBy("rank").collect()] == list(range(1, 10)) and got.count() == 20 * 9


def test_containment_against_all_pairs(spark):
    rng = random.Random(8)
    word = lambda: rng.choice(["가나", "다", "ab", "c", "é", "xyz", " "])
    docs = [(i, "".join(word() for _ in range(rng.randrange(0, 120)))) for i in range(60)] + [(60, None), (61, "")]
    phrases = [(i, "".join(word() for _ in range(rng.randrange(0, 25)))) for i in range(80)] + [(80, docs[3][1]), (81, None), (82, "ab"), (83, "ab")]
    d, p = spark.createDataFrame(docs, "doc int, t string").repartition(4), spark.createDataFrame(phrases, "k int, p string")
    want = sorted((k, i) for k, x in phrases if x for i, t in docs if t and x in t)
    for size in (1 << 20, 1000):
        assert sorted(map(tuple, contain.containing(d, p, "doc", "t", "k", "p", size).collect())) == want
    assert contain.containing(d, p.limit(0), "doc", "t", "k", "p").count() == 0


@pytest.mark.parametrize("step", [40, 1 << 17])
def test_containment_of_phrases_of_every_length(monkeypatch, step):
    monkeypatch.setattr(contain, "_STEP", step)
    monkeypatch.setattr(contain, "_TEXTS", 500)
    rng = random.Random(9)
    word = lambda n: "".join(rng.choice(["a", "b", "é", "가"]) for _ in range(n))
    base = word(300)
    texts = [word(rng.randrange(0, 400)) for _ in range(40)] + [base, None, "", base[:70] + base[80:], "a" * 200]
    cuts = [(rng.choice([t for t in texts if t]), rng.randrange(0, 200), n) for n in range(1, 150)]
    phrases = [t[i : i + n] for t, i, n in cuts] + [base[:n] for n in range(20, 100)] + [base[:69] + "x", "a" * 63, "a" * 64, "a" * 200, "a" * 201, "", base, base]
    index, got = contain.Phrases(phrases), []
    for lo, _, raw, offsets in contain._pieces(pa.array(["left out", *texts]).slice(1)):
        doc, phrase = index.within(raw, offsets)
        got += zip((doc + lo).tolist(), phrase.tolist(), strict=True)
    assert sorted(got) == sorted((i, j) for i, t in enumerate(texts) for j, p in enumerate(phrases) if t and p and p in t)


def test_common_words_are_not_compared_one_at_a_time():
    """Words of six letters and more begin alike, and prose is full of them: calls follow the steps of the text, not its words."""
    words = [a + b for a in ("inter", "prefe", "consider") for b in ("nal", "red", "rence", "ring", "able", "ation", "vention", "mittent")]
    rng, calls = random.Random(3), 0
    texts = ["".join(rng.choices(words, k=5000)).encode() for _ in range(8)]
    index, raw, offsets = contain.Phrases(words), np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])

    def count(*_):
        nonlocal calls
        calls += 1

    sys.setprofile(count)
    try:
        doc, phrase = index.within(raw, offsets)
    finally:
        sys.setprofile(None)
    assert sorted(zip(doc.tolist(), phrase.tolist(), strict=True)) == [(i, j) for i, t in enumerate(texts) for j, w in enumerate(words) if w.encode() in t]
    assert calls < 8 * 5000 / 2


def test_keyword_frequency_sends_counts_not_pairs(spark):
    docs = [(f"ab {i % 3} keyword other {'x' * (i % 5)}",) for i in range(300)] + [(None,), ("",)]
    c, k = spark.createDataFrame(docs, "content string").coalesce(1), spark.createDataFrame([("key word",), ("keyword",), ("other",), ("xxx",), ("ab1k",), ("absent",), ("",), (None,)], "term string")
    got = questions.keyword_frequency(k, c)
    want = {t: sum(t.replace(" ", "") in d.replace(" ", "") for (d,) in docs if d) for (t,) in k.collect() if t}
    assert dict(map(tuple, got.collect())) == {t: n for t, n in want.items() if n} and got.dtypes == [("term", "string"), ("df", "bigint")]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "mapinarrow" in plan.lower() and "monotonically" not in plan
    for size in (1 << 20, 100):
        assert contain.frequency(c, k.withColumn("word", k.term), "content", "term", "word", size).where("term = 'keyword'").first().df == 300


def test_answers_with_citations(spark):
    c = spark.createDataFrame([("t1", "골절 보장 내용", [0.5, 1.0], "제3조", "특약A"), ("t2", "골절 보장", [1.0, 0.1], "제5조", None), ("t3", "다른 글", [1.0, 0.0], "제7조", None)], "id string, text string, embedding array<double>, clause_no string, exhibit string")
    q = spark.createDataFrame([(1, "골절 보장", [1.0, 0.0], None), (2, "골절 보장", [1.0, 0.0], "화재보험"), (3, "자동차", [1.0, 0.0], None)], "qid int, text string, embedding array<double>, insurance_type string")
    got = {r.qid: r for r in retrieval.answers(c, q).collect()}
    assert [x.id for x in got[1].chunks] == ["t2", "t1", "t3"] and [(x.clause_no, x.exhibit) for x in got[1].citations] == [("제5조", None), ("제3조", "특약A"), ("제7조", None)]
    assert got[2].chunks == [] and got[3].citations == []
    r = {(x.method, x.id) for x in retrieval.methods(c, q.where("qid = 1")).collect()}
    assert ("bm25", "t1") in r and ("rrf", "t3") in r and ("bm25", "t3") not in r
    both = retrieval.rewritten(c, q.where("qid = 1"), q.where("qid = 1")).orderBy("rank").first()
    assert both.id == "t2" and abs(both.score - (2 / 61 + 2 / 62)) < 1e-8
    shapes = spark.createDataFrame([(1, "질문", ("말", None, "다음", "보고"))], "qid int, question string, variants struct<utterance:string,rewritten:string,followup:string,report:string>")
    assert [(x.variant, x.text, x.rerank_text) for x in retrieval.variant_queries(shapes).collect()] == [("utterance", "말", "말"), ("rewritten", "질문", "말"), ("followup", "다음", "다음"), ("report", "보고", "보고")]


def test_grids_and_reports(spark):
    r = evaluation.grid(spark.createDataFrame([("q",)], "qid string"), version=["v1", "v2"], mode=["strict", "lenient"])
    assert r.count() == 4
    s = spark.createDataFrame([("a", "m", 0.5), ("b", "m", 0.75), ("b", "n", 0.1)], "variant string, method string, r5 double")
    assert {(x.variant, x.method): x.delta for x in evaluation.against(s, "variant", "a", "method").collect()} == {("a", "m"): 0.0, ("b", "m"): 0.25, ("b", "n"): 0.0}
    assert evaluation.report(s.where("method = 'm'"), "t", ["variant"]).splitlines()[-1] == "| b | m | 0.750 |"
    a = evaluation.accuracy(spark.createDataFrame([(1, "x", 2.0), (2, None, 4.0)], "k int, predicted string, s double"), spark.createDataFrame([(1, "x"), (2, "y")], "k int, gold string"), "k", seconds="s").first()
    assert (a.n, a.accuracy, a.latency) == (2, 0.5, 3.0)


def test_headings_that_pages_share_are_looked_up_once(spark, tmp_path, monkeypatch):
    from quarry.plans import corpus

    spark.createDataFrame([(i, f"<h1>{'Same head' if i < 50 else 'No line'}</h1>") for i in range(60)], "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame([(1, "x Same head y\nother")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    asked, real = [], contain.containing
    monkeypatch.setattr(corpus.contain, "containing", lambda docs, phrases, *how: asked.append(phrases.count()) or real(docs, phrases, *how))
    assert sorted(map(tuple, corpus.toc_containment_match(spark, str(tmp_path)).collect())) == [(i, "Noline") for i in range(50, 60)] and asked == [2]
