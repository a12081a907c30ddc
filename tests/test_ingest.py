"""Documents from pages and lines to chunks with their status; extractors and models that fail; settings."""

import json

import pytest
from pyspark.sql import functions as F
from test_scans import SCHEMA, document

from quarry import session
from quarry.operators import checks, ingest, models
from quarry.sources import extract, readers, sinks

DOCS = "doc_hash string, source_pdf string, doc_type string, insurer string, product_name string, product_code string"
PAGES = "doc_hash string, page int, text string, tables array<struct<markdown:string,source:string>>"


@pytest.fixture(scope="module")
def inputs(spark):
    lines = spark.createDataFrame(document(), SCHEMA)
    body = "본문은 길게 이어집니다. " * 10
    big = "|h|\n|---|\n" + "\n".join(f"|{i}|" for i in range(45))
    pages = [("d", 1, "표지 글이 여기에 있습니다 " * 3, [])]
    pages += [("d", 3, f"제1조(목적)\n{body}", [])]
    for i, name in enumerate(["골절진단비 특별약관", "화상진단비 특별약관", "상해입원일당 특별약관", "깁스치료비 특별약관"]):
        pages += [("d", 5 + i, f"{name}\n\n제1조(지급사유)\n{body}\n\n제2조(정의)\n{body}{name}", [(big, "vlm")] if i == 1 else [])]
    pages += [("s", 1, "x", [("|a|\n|b|", "pymupdf"), ("  ", "vlm")]), ("s", 2, "", None), ("p", 1, "짧다\n\n" + "해지 환급금에 관한 글입니다. " * 30, None), ("p", 2, None, None)]
    docs = [("d", "보통약관.pdf", None, "사", "상품", "c"), ("s", "보험료표.pdf", None, "사", "상품", None), ("p", "x.pdf", None, "사", "상품", None), ("none", "y.pdf", None, "사", "상품", None), ("old", "z.pdf", None, "사", "상품", None)]
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(pages, PAGES).repartition(3), lines


def test_ingest_from_end_to_end(spark, inputs):
    docs, pages, lines = inputs
    store = spark.createDataFrame([("c0", "old", 1)], "chunk_id string, doc_hash string, chunk_index int")
    out = ingest.ingest(docs, pages, lines, store)
    status = {r.doc_hash: (r.status, r.chunks) for r in out["status"].collect()}
    assert status["old"] == ("SKIPPED", 0) and status["none"] == ("ERROR", 0) and status["s"][0] == "OK" and ingest.failed(out["status"])
    rows = out["chunks"].collect()
    d = sorted((r for r in rows if r.doc_hash == "d"), key=lambda r: r.chunk_index)
    assert [r.chunk_index for r in d] == list(range(1, len(d) + 1)) and len({r.chunk_id for r in rows}) == len(rows)
    assert all("표지" not in r.content for r in d) and {r.section for r in d} >= {"골절진단비 특별약관", "화상진단비 특별약관"}
    windows = [r for r in d if r.table_id]
    assert [(r.row_start, r.row_end) for r in windows] == [(1, 20), (21, 40), (41, 45)] and len({r.table_id for r in windows}) == 1 and all("|h|\n|---|" in r.content for r in windows)
    t = out["tables"].collect()
    assert len(t) == 1 and (t[0].row_count, t[0].col_count, t[0].source) == (45, 1, "vlm") and t[0].table_id == windows[0].table_id
    part = next(r for r in d if r.article_no == 2 and r.section == "골절진단비 특별약관")
    assert part.content.startswith("사 | 상품 | 골절진단비 특별약관 | 제2조(정의)\n[골절진단비 특별약관 > 제2조(정의)]\n")
    first = [r for r in d if r.article_no == 1 and r.section.endswith("특별약관")]
    assert sorted(r.is_boilerplate for r in first) == [False, True, True, True] and len({r.canonical_id for r in first if r.is_boilerplate}) == 1
    p = [r for r in rows if r.doc_hash == "p"]
    assert len(p) == 1 and p[0].chunk_type == "termination" and p[0].section == "상품" and p[0].content.startswith("사 | 상품\n짧다\n해지")
    again = {r.chunk_id for r in ingest.ingest(docs, pages, lines, store)["chunks"].collect()}
    assert again == {r.chunk_id for r in rows}
    assert out["store"].count() == len(rows) + 1
    full = out["store"]
    assert ingest.ingest(docs, pages, lines, full)["chunks"].count() == 0
    over = ingest.ingest(docs, pages, lines, full, overwrite=True)
    assert over["store"].count() == full.count() and over["status"].where("status = 'SKIPPED'").count() == 0


def test_ingest_of_nothing(spark, inputs):
    docs, pages, lines = (x.limit(0) for x in inputs)
    out = ingest.ingest(docs, pages, lines)
    assert all(out[k].count() == 0 for k in ("chunks", "tables", "issues", "status")) and not ingest.failed(out["status"])


def test_extractors_fail_alone(spark):
    pages = spark.createDataFrame([("d", i, bytearray([i])) for i in range(1, 6)], "doc string, page int, content binary")

    def lattice(content, page):
        if page == 2:
            raise ValueError("no lines")
        return [[["h", "x|y"], ["a", None]]] if page < 4 else None

    def stream(content, page):
        return ["|s|"] if page == 2 else 1 / 0 if page == 5 else []

    got = {r.page: r for r in extract.tables(pages, "flavours", lattice, stream).collect()}
    assert got[1].markdown.startswith("| h | x／y |") and got[2].markdown == "|s|" and got[4].markdown is None and got[4].error is None and "ZeroDivisionError" in got[5].error
    model = extract.tables(pages, "vlm", lambda c, n: "```\n|m|\n```" if n == 1 else "NO_TABLE", cap=2, answers=True)
    assert sorted((r.page, r.markdown) for r in model.collect() if r.markdown) == [(1, "|m|")] and model.count() == 2
    both = readers.table_candidates(("flavours", extract.found(extract.tables(pages, "flavours", lattice, stream))), ("vlm", extract.found(model)))
    assert sorted((r.page, r.source) for r in both.collect()) == [(1, "flavours"), (1, "vlm"), (2, "flavours"), (3, "flavours")]

    def read(path):
        if path == "bad":
            raise OSError("gone")
        return path.encode()

    f = {r.path: r for r in extract.fetched(spark, spark.createDataFrame([("a",), ("bad",)], "path string"), read).collect()}
    assert bytes(f["a"].content) == b"a" and "gone" in f["bad"].error
    import hashlib

    parts = spark.createDataFrame([("1", "a", bytearray(b"x"), hashlib.sha256(b"x").hexdigest()), ("2", "b", bytearray(b"y"), "0"), ("3", "b", bytearray(b"2"), None), ("3", "a", bytearray(b"1"), None), ("4", "a", bytearray(b""), None)], "page_id string, name string, content binary, sha256 string")
    w = {r.page_id: ([bytes(c) for c in r.content], r.sha) for r in extract.whole_files(parts).collect()}
    assert w == {"1": ([b"x"], "equal"), "2": ([b"y"], "different"), "3": ([b"1", b"2"], "parts"), "4": ([b""], "missing")}


def test_models_that_fail(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "bad"), (3, None), (4, "c")], "k int, t string")

    def model(texts):
        if "bad" in texts:
            raise RuntimeError
        return ['```json\n{"answerable": true}\n```' if t == "a" else "{}" for t in texts]

    a = {r.k: r.answer for r in models.ask(rows, "k", F.col("t"), model, ("answerable",)).collect()}
    assert json.loads(a[1]) == {"answerable": True} and a[2] is None and a[3] is None and a[4] is None
    j = {r.k: r.answerable for r in models.judge(rows, "k", F.col("t"), F.lit("x"), lambda ts: ['{"answerable": false}'] * len(ts)).collect()}
    assert j == {1: False, 2: False, 3: None, 4: False}
    v = {r.k: r.embedding for r in models.embed(rows, "k", "t", lambda ts: [[len(t), 1.0] for t in ts], 2, skip=F.col("k") == 4, prefix="q: ", most=1).collect()}
    assert v[1] == [4.0, 1.0] and v[2] == [4.0, 1.0] and v[3] == [4.0, 1.0] and v[4] is None
    with pytest.raises(Exception, match="vectors of 3"):
        models.embed(rows, "k", "t", lambda ts: [[1.0]] * len(ts), 3).collect()
    q = models.questions_of(spark.createDataFrame([(1, '{"questions": [{"qtype": "t", "question": "왜?", "answer_span": "s", "keywords": ["k"]}, {"question": ""}]}'), (2, None)], "k int, answer string"), "k").collect()
    assert [(r.k, r.question, r["keywords"]) for r in q] == [(1, "왜?", ["k"])]
    who = [r[0] for r in spark.range(100).select(models.persona(F.col("id"), 17)).collect()]
    assert set(who) == set(models.PERSONAS) and who == [r[0] for r in spark.range(100).select(models.persona(F.col("id"), 17)).collect()]
    pair = "struct<section:string,article:string>"
    long = "보험금을 지급하지 않는 사유를 정합니다"
    jq = spark.createDataFrame([(1, True, True, "t", long, "t", long, [("s", "1")], ("a", "2")), (2, True, True, "t", long, "u", long, [("s", "1")], ("a", "2")), (3, True, False, "t", long, "t", long, [("s", "1")], None), (4, None, True, "t", long, "t", long, [("s", "1")], ("a", "2"))], f"qid int, pos boolean, neg boolean, title string, content string, other_title string, other_content string, gold array<{pair}>, other_gold {pair}")
    got = {r.qid: (r.verdict, len(r.gold)) for r in models.judged(jq).collect()}
    assert got == {1: ("absorbed", 2), 2: ("judge_neg", 1), 3: ("kept", 1), 4: ("judge_pos", 1)}
    b = models.extraction_benchmark(spark.createDataFrame([("p", "v", 2.0, "|x|"), ("p", "v", 4.0, None)], "policy string, backend string, sec_per_page double, markdown string")).first()
    assert (b.pages, b.found, b.seconds) == (2, 1, 3.0)


def test_stores_manifests_and_settings(spark, tmp_path):
    p = str(tmp_path / "store")
    assert sinks.init_store(spark, p) and not sinks.init_store(spark, p) and not sinks.init_store(spark, p + "2", skip=True) and spark.read.parquet(p).count() == 0
    sinks.table_files(spark.createDataFrame([("t1", "|a|\n|b|"), (None, "x")], "table_id string, markdown string"), str(tmp_path / "tables"))
    assert spark.read.text(str(tmp_path / "tables" / "table_id=t1")).count() == 2
    m = tmp_path / "docs.yaml"
    m.write_text("# all\ndocuments:\n  - pdf: a.pdf\n    insurer: 사\n    product_name: '상품'\n    effective_date: 2024-01-02\n  - pdf: b.pdf\n    insurer: i\n    product_name: p\nother: 1\n")
    got = readers.manifest_file(spark, str(m)).orderBy("pdf").collect()
    assert [(r.pdf, r.product_name, str(r.effective_date)) for r in got] == [("a.pdf", "상품", "2024-01-02"), ("b.pdf", "p", "None")]
    with pytest.raises(ValueError):
        readers.manifest(spark, readers.manifest_rows("documents:\n"))
    s = session.settings({"target": 3}, {"OVERWRITE": "yes", "LIMIT": "7"}, {"target": 500, "overwrite": False, "limit": 1, "model": "m"})
    assert s == {"target": 3, "overwrite": True, "limit": 7, "model": "m"}
    with pytest.raises(ValueError):
        session.settings({}, {}, {"db_url": ...})
    have = session.capabilities({"json": "json", "none": "no_such_module"})
    assert have == {"json": True, "none": False} and session.needs("none", fallback=1, modules={"none": "no_such_module"}) == 1
    with pytest.raises(RuntimeError):
        session.needs("none", modules={"none": "no_such_module"})


def test_indicators(spark):
    src = spark.createDataFrame([("d", p, "가나다라마바사아자차카타파하" * 4) for p in (1, 2, 3)], "k string, page int, text string")
    ch = spark.createDataFrame([("d", 2, 1, "가나다라마바사아자차카타파하" * 4)], "k string, page int, seq int, chunk_text string")
    c = checks.coverage(src, ch, "k", "seq", page="page")
    assert {(r.page, r.probes, r.found) for r in c.collect()} == {(1, 2, 2), (2, 2, 2), (3, 2, 2)}
    far = checks.coverage(src.withColumn("page", F.col("page") * 5), ch, "k", "seq", page="page")
    assert [(r.page, r.missing) for r in checks.worst(far, "k", "page").orderBy("rank").collect()] == [(5, 1.0), (10, 1.0), (15, 1.0)]
    best = spark.createDataFrame([("d", 1, "vlm", "a b"), ("d", 2, "pymupdf", "a  b")], "doc string, page int, source string, markdown string")
    cand = best.unionByName(spark.createDataFrame([("d", 1, "pymupdf", "a  b  c")], best.schema))
    w = checks.win_rate(best, cand).first()
    assert (w.pages, w.win_rate, w.gain) == (2, 0.5, 1.0)
    m = checks.match_rate(spark.createDataFrame([("d", "골절진단비특별약관"), ("d", "없는특약"), ("e", "x")], "doc string, title string"), spark.createDataFrame([("d", "골절진단비"), ("d", "")], "doc string, section string"), "doc").orderBy("doc").collect()
    assert [(r.doc, r.rate, r.missing) for r in m] == [("d", 0.5, ["없는특약"]), ("e", 0.0, ["x"])]
    ch2 = spark.createDataFrame([("d", "절", None, False, 1), ("d", "절", 1, False, 2), ("d", "별표1", None, False, 3), ("d", "절", None, False, 4), ("d", "절", None, False, 5), ("d", None, None, False, 6)], "doc_hash string, section string, article_no int, is_table boolean, o int")
    r = checks.adjusted_restore_rate(ch2, ["o"]).first()
    assert (r.total, r.restored, r.appendix, r["first"], r.other, r.adjusted) == (5, 1, 1, 2, 1, 0.5)


def test_probes_of_a_long_text_are_found_in_one_pass():
    import random
    import time

    r = random.Random(3)
    text = "".join(r.choice("abcdefgh") for _ in range(400_000))
    whole = text[200_000:] + text[:100_000]
    pieces = [text[i : i + 12] for i in range(0, len(text) - 11, 40)]
    t = time.process_time()
    got = checks.probe_hits(text, whole)
    took, every = time.process_time() - t, {whole[j : j + 12] for j in range(len(whole) - 11)}
    assert took < 10 and got == (len(pieces), sum(p in every for p in pieces))
    assert checks.probe_hits("short", None) == (0, 0) and checks.probe_hits("a" * 12 + "b" * 40, "b" * 11 + "a" * 12) == (2, 1)
