import pytest
from pyspark.sql import functions as F

from quarry.functions import pyfuncs as P
from quarry.functions import text as X
from quarry.operators import checks, classify, segment


def values(spark, columns, rows, schema):
    return [list(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_scalars(spark):
    rows = [("제5조(특별부활(효력회복)) 본문",), (" 제 12 조의2【가 나】",), ("제3조[x]",), ("본문 제1조(가)",), ("",)]
    got = values(spark, [X.article_no(X.strip(F.col("t"))), X.article_title(X.strip(F.col("t"))), X.tokens(F.col("t"))], rows, "t string")
    assert [g[:2] for g in got] == [[5, "특별부활(효력회복)"], [12, "가 나"], [3, "x"], [None, None], [None, None]]
    assert got[-1][2] == 0
    got = values(spark, [X.strip(F.col("t")), X.dense(F.col("t")), X.toc_norm(F.col("t")), X.double_spaces(F.col("t")), X.hangul_digits(F.col("t"))], [("  - 13. 입 원  일당\n",)], "t string")
    assert got == [["- 13. 입 원  일당", "-13.입원일당", "입원일당", 1, 6]]
    got = values(spark, [X.strip_fences(F.col("t")), X.head3(F.array(*[F.lit(float(i)) for i in range(5)])), X.cosine(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(1.0), F.lit(1.0)))], [("```md\n|a|\n```",)], "t string")
    assert got[0][0] == "|a|" and got[0][1] == [0.0, 1.0, 2.0] and abs(got[0][2] - 0.5**0.5) < 1e-12


def test_tables_from_html_and_otsl():
    html = "<table><tr><th rowspan=2>a</th><th colspan=2>b|c</th></tr><tr><td>d</td><td> e <br>f</td></tr></table>"
    assert P.html_grid(html) == [["a", "b／c", "b／c"], ["a", "d", "e f"]]
    assert P.otsl_grid("<otsl><fcel>a<lcel><nl><ucel><fcel>b<nl><ecel><xcel><nl></otsl>") == [["a", "a"], ["a", "b"], ["", "b"]]
    assert P.rows_to_markdown([["h"], ["a", None]]) == "| h |  |\n| --- | --- |\n| a |  |" and P.rows_to_markdown(None) == ""
    assert P.rows_to_markdown([["a\nb", "c|d"], [" e ", None]]) == "| a b | c／d |\n| --- | --- |\n| e |  |" and P.rows_to_markdown([["", None]]) == ""
    assert P.otsl_grid("<fcel>a\\nb<nl><nl><fcel>c<nl>") == [["a b"], ["c"]]
    assert P.table_markdown("```md\n|a|\n```") == "|a|" and P.table_markdown("NO_TABLE") is None and P.table_markdown("<fcel>a<nl>").startswith("| a |") and P.table_markdown("<table><tr><td>x</table>").startswith("| x |") and P.table_markdown("text") is None
    assert P.html_grid(None) == [] and P.html_grid("<td>x") == [["x"]]


def test_text_comparison(spark):
    assert P.common_run("abcdef", "xxcdeyy") == 3 and P.common_run(None, "a") == 0
    assert P.snap("0123 456789ab", "z0123456789\nabz") == "0123456789ab" and P.snap("0123456789abcdef", "__0123456789abc__") == "0123456789abc" and P.snap("abc", "zabcz") is None and P.snap(None, "a") is None
    assert values(spark, [P.udf(P.common_run)("a", "b"), P.udf(P.similarity)("a", "b")], [("abcd", "bcde")], "a string, b string") == [[3, 0.75]]


def test_splits(spark):
    items = "머리말\n" + "\n".join(f"{i}. " + "가" * 200 for i in range(1, 5))
    got = values(spark, [segment.enumerated(F.col("t"))], [(items,), ("1. 짧다\n2. 나",)], "t string")
    assert len(got[0][0]) == 4 and all(p.startswith("머리말\n") for p in got[0][0]) and got[1][0] == ["1. 짧다\n2. 나"]
    long = "\n".join("a" * 300 for _ in range(8))
    got = values(spark, [segment.hard_split(F.col("t"))], [(long,), ("x",)], "t string")
    assert [len(p) for p in got[0][0]] == [601] * 4 and got[1][0] == ["x"]
    got = values(spark, [segment.children(F.col("t"))], [("머리 " + "나" * 50 + "① " + "다" * 50 + "② 짧다",)], "t string")
    assert [p[0] for p in got[0][0]] == ["머", "①"] and got[0][0][1].endswith("② 짧다")


def test_bodies_and_kinds(spark):
    rows = [("사 | 상품 | 절\n[절 > 제1조(가)]\n제1조(가)\n본문\n둘째",), ("| a | b |\n| c | d |",), ("사 | 상품",), ("본문 | 없음\n글",), (None,)]
    assert [r[0] for r in values(spark, [X.body_of(F.col("t"))], rows, "t string")] == ["본문\n둘째", "| a | b |\n| c | d |", "사 | 상품", "글", None]
    assert [r[0] for r in values(spark, [X.section_kind(F.col("t"))], [("별표1 표",), ("장해분류표",), ("골절 특약",), ("보통",)], "t string")] == ["별표", "별표", "특별약관", "보통약관"]
    assert values(spark, [X.boundary_norm(F.col("t")), X.probe_norm(F.col("t"))], [(" 13. 입 원 [일당]·1",)], "t string") == [["입원[일당]·1", "13입원일당1"]]
    assert X.cache_name("emb", "questions") == "emb" and X.cache_name("emb", "gen", "report") == "emb_gen_report"


def test_parts_at_headings(spark):
    lone = "앞 글입니다\n제1조(목적)\n본문이 이어집니다\n제2조(정의)\n다른 본문입니다"
    listed = "앞 글입니다\n제297조(가)\n제298조(나)\n제299조(다)\n뒤 글입니다"
    got = values(spark, [segment.article_parts(F.col("t"))], [(lone,), (listed,), ("글",), (None,)], "t string")
    assert [len(g[0]) for g in got] == [3, 1, 1, 0] and got[0][0][1].startswith("제1조")


def test_runs_become_one(spark):
    rows = [("d", 1, "절", "제1조(가)", 1, False), ("d", 2, "절", "제2조(나)", 2, False), ("d", 3, "절", "본문", 2, False), ("d", 4, "절", "제3조(다)", 3, False), ("d", 5, "다른", "제4조(라)", 4, False)]
    df = spark.createDataFrame([(*r[:5], None, r[5]) for r in rows], "doc_hash string, ord int, section string, body string, article_no int, article_title string, is_table boolean")
    got = [(r.ord, r.body, r.article_no, r.article_title) for r in segment.merge_titles(df).orderBy("ord").collect()]
    assert got == [(1, "제1조(가)\n제2조(나)", None, "인용 조문"), (3, "본문", 2, None), (4, "제3조(다)", 3, None), (5, "제4조(라)", 4, None)]


def test_packing_is_the_fold_over_each_document(spark):
    import random

    rng = random.Random(3)
    rows = [(k, i, "x" * rng.randrange(0, 60), rng.choice("ab")) for k in range(6) for i in range(40)]
    df = spark.createDataFrame(rows, "k int, seq int, line string, label string").repartition(5)
    for before in (True, False):
        for labels in ((), ("label",)):
            want = []
            for k in range(6):
                run = []
                for r in [r for r in rows if r[0] == k]:
                    if run and labels and run[-1][3] != r[3]:
                        want.append((k, run))
                        run = []
                    run.append(r)
                want.append((k, run))
            packs = []
            for k, run in want:
                group = list(segment.pack([len(r[2]) * 6 // 10 for r in run], 50, before))
                packs += [(k, run[group.index(g)][1], "\n".join(r[2] for r, h in zip(run, group, strict=True) if h == g)) for g in sorted(set(group))]
            got = [(r.k, r.first_seq, r.text) for r in segment.packed(df, "k", before, 50, *labels).collect()]
            assert sorted(got) == sorted(packs)


def test_even_pages_and_order(spark):
    p = spark.createDataFrame([("d", i) for i in range(1, 11)] + [("e", 4), ("e", 2)], "doc string, page int")
    assert sorted((r.doc, r.page) for r in segment.even_pages(p, 3).collect()) == [("d", 1), ("d", 4), ("d", 7), ("e", 2), ("e", 4)]


def test_rows_of_large_tables(spark):
    md = lambda n: "|h|\n|---|\n" + "\n".join(f"|{i}|" for i in range(n))
    rows = segment.row_windows(spark.createDataFrame([(1, md(20)), (2, md(21))], "k int, md string"), "k", "md").orderBy("k", "part").collect()
    assert [(r.k, r.row_start, r.row_end) for r in rows] == [(1, 1, 20), (2, 1, 20), (2, 21, 21)] and rows[2].text == "|h|\n|---|\n|20|" and rows[0].text == md(20)


def test_best_table_and_boilerplate(spark):
    t = spark.createDataFrame([("d", 1, "pymupdf", "a  b"), ("d", 1, "vlm", "a  b"), ("d", 1, "x", "a  b  c"), ("d", 2, "z", "a"), ("d", 2, "pymupdf", "a  b")], "doc string, page int, source string, markdown string")
    assert sorted((r.page, r.source) for r in segment.best_table(t).collect()) == [(1, "vlm"), (2, "z")]
    c = spark.createDataFrame([("a", 1, "k"), ("b", 2, "k"), ("c", 3, ""), ("d", 4, "")], "chunk_id string, chunk_index int, k string")
    got = {r.chunk_id: (r.is_boilerplate, r.canonical_id) for r in segment.boilerplate(c, F.col("k"), ["chunk_index"]).collect()}
    assert got == {"a": (False, None), "b": (True, "a"), "c": (False, None), "d": (False, None)}


def test_chunks_without_a_key_are_dealt_over_all_tasks(spark):
    c = spark.range(4000).select(F.col("id").cast("string").alias("chunk_id"), F.col("id").alias("chunk_index"), F.when(F.col("id") < 4, F.lit("k")).alias("k"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for k, v in zip(old, ("-1", "false"), strict=True):
            spark.conf.set(k, v)
        n = [r["count"] for r in segment.boilerplate(c, F.col("k"), ["chunk_index"]).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sum(n) == 4000 and max(n) < 2000


def test_headers_and_classes(spark):
    h = segment.header(F.col("l"), F.col("a"), F.col("t"), F.col("k"))
    got = values(spark, [h], [("특약", 3, "가", "yak"), ("보통", 3, None, "base"), (None, None, None, "front")], "l string, a int, t string, k string")
    assert got == [["[특약 > 제3조(가)]"], ["[제3조]"], ["[기타]"]]
    rows = [("보험금을 지급하지 않습니다", None), ("보장하는 손해", None), ("용어의 정의", "특별약관"), ("이 특약에서 정하지 않은 사항은 보통약관을 따릅니다", None), ("보험금 면책", None)]
    c = classify.chunk_class(F.col("t"), F.col("l"))
    got = values(spark, [c, classify.rule_class(F.col("t"), F.lit(None).cast("string")), classify.ambiguous(F.col("t"), classify.plain_class(F.col("t")))], rows, "t string, l string")
    assert [g[0] for g in got] == ["exclusion", "coverage", "special_clause", "special_clause", "exclusion"] and got[3][1] == "special_clause" and got[0][1] is None and got[4][2] and not got[1][2]
    assert values(spark, [classify.document_type(F.col("n"))], [("상품요약서.pdf",), ("보통약관.pdf",), ("보험료표",), ("x",)], "n string") == [["product_summary"], ["policy_terms"], ["schedule"], ["product_summary"]]


def test_validation(spark):
    c = spark.createDataFrame([("1", "  \n", 20, "general", "a"), ("2", "x", 5, "general", "a"), ("3", "x", 700, "odd", None), ("4", "x", 20, "claim", "a")], "chunk_id string, content string, token_count int, chunk_type string, insurer string")
    ok, bad = checks.validate(c, "insurer")
    assert sorted(r.chunk_id for r in ok.collect()) == ["3", "4"]
    assert sorted((r.chunk_id, r.issue) for r in bad.collect()) == [("1", "blank"), ("2", "tiny"), ("3", "long"), ("3", "missing"), ("3", "type")]


@pytest.mark.parametrize("n", [0, 1])
def test_empty_inputs(spark, n):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert segment.packed(segment.lines(df), "doc_id", bool(n), 5).count() == 0
