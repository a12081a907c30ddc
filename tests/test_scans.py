from pyspark.sql import functions as F

from quarry.operators import scans as S


def line(page, text, size=10.0, bold=False, alone=False, no=0, doc="d"):
    return (doc, page, no, 0, text, size, bold, alone, 0.0, 0.0, 10.0, 10.0)


SCHEMA = "doc_hash string, page int, block_no int, line_no int, text string, font_size double, is_bold boolean, is_isolated boolean, x0 double, y0 double, x1 double, y1 double"


def document():
    rows = [("무배당 안심상해보험", 20.0, 1), ("가입자 유의사항", 10.0, 1)]
    rows += [("제1조(목적) 이 약관은 정한 바에 따릅니다.", 10.0, 3), ("본문은 길게 이어집니다. " * 10, 10.0, 3)]
    for i, name in enumerate(["골절진단비 특별약관", "화상진단비 특별약관", "상해입원일당 특별약관", "깁스치료비 특별약관"]):
        rows += [(name, 14.0, 5 + i), ("제1조(지급사유) 회사는 정한 바에 따릅니다.", 10.0, 5 + i), ("본문은 길게 이어집니다. " * 10, 10.0, 5 + i)]
    rows += [("【별표1】 장해분류표", 14.0, 12)]
    return [line(p, t, s, s > 12, s > 12, no=i) for i, (t, s, p) in enumerate(rows)]


def test_boundaries_of_a_document(spark):
    df = spark.createDataFrame(document(), SCHEMA).repartition(3)
    d = S.detect(df).first()
    assert (d.body_size, d.title_size, d.base_start_page, d.level) == (10.0, 14.0, 3, "ok") and "안심상해보험" in d["product"]
    got = [(r.page, r.label, r.kind) for r in S.boundaries(df).orderBy("ord").collect()]
    assert [g[2] for g in got] == ["base", "yak", "yak", "yak", "yak", "byeolpyo"]
    assert got[1][1] == "골절진단비 특별약관" and got[-1] == (12, "별표1 장해분류표", "byeolpyo") and got[0][0] == 3
    weak = S.detect(spark.createDataFrame([line(1, "x")], SCHEMA)).first()
    assert weak.level == "weak" and "no product" in weak.reasons and "few titles" in weak.reasons
    pages = spark.createDataFrame([("d", p) for p in (1, 3, 4, 5, 6, 20)], "doc_hash string, page int")
    lab = {r.page: (r.label, r.kind) for r in S.label_pages(pages, S.boundaries(df)).collect()}
    assert lab[1] == (None, "front") and lab[4][1] == "base" and lab[6][0] == "화상진단비 특별약관" and lab[20][1] == "byeolpyo"


def test_a_title_over_two_lines():
    found = {"base_start_page": 1, "title_size": 14.0, "product": None}
    x = lambda t, s: {"page": 2, "t": t, "font_size": 14.0, "mark": None, "skip": False, "bare": s == 0, "score": s}
    got = S.boundary_rows([x("2-1. 갱신형 중증화상 보장", 3.0), x("특별약관", 0.0)], found)
    assert [g[1] for g in got if g[2] == "yak"] == ["2-1. 갱신형 중증화상 보장 특별약관"]


def test_dividers_and_appendix_heads(spark):
    is_divider = {"1. 골절(재골절제외)담보": False, "5. 기타 특별약관": True, "Ⅰ. 상해 관련 특별약관": True, "상해담보": True, "제1관 목적": True, "3. 화상진단비(감액없음)보장 특별약관": False, "2. 질병 관련 특별약관": True}
    assert {t: S._divider(t, None) for t in is_divider} == is_divider
    assert S._divider("안심보험 특별약관", None) and S._divider("나의 특별약관", "나의") and not S._divider("골절진단비 특별약관", None)
    heads = {"특별약관 색인": True, "가나다순 특별약관 색인": True, "무배당 특별약관 색인": False, "인용된 법·규정": True, "인용 법 규정": False, "약관 요약서": True, "인용된 법 전문과 규정": False}
    import re

    assert {t: bool(re.search(S.APPENDIX_HEAD, t)) for t in heads} == {**heads, "인용 법 규정": bool(re.match(r"^인용된?\s*법[\W\s]*규정", "인용 법 규정"))}
    rows = [line(2, "【별표 2】  가  나", 14.0, no=0), line(2, "손해는 보상한다. 2. 화상진단비(감액없음) 특별약관", 14.0, True, True, no=1), line(2, "질병 분류표", 10.0, no=2)]
    d = spark.createDataFrame(document() + [(r[0], 20, *r[2:]) for r in rows], SCHEMA)
    f = {r.block_no: r for r in S.line_features(d, S.detect(d)).where("page = 20").collect()}
    assert f[0].mark == "별표2 가 나" and f[1].t == "2. 화상진단비(감액없음) 특별약관" and f[2].mark is None and not f[2].skip


def test_contents_range_and_titles(spark):
    r = spark.createDataFrame([(None, 300), (None, 20), (2, 1232), (8, 30), (50, 400), (0, 300)], "f int, n int").select(S.contents_range(F.col("f"), F.col("n")))
    assert [x[0] for x in r.collect()] == [48, 20, 63, 30, 53, 48]
    assert S.split_compound("가/나(다/라)/마") == ["가", "나(다/라)", "마"] and S.split_compound("가)/나") == ["가)", "나"] and S.split_compound("(가/나)") == ["(가/나)"] and S.split_compound("") == [""]
    got = S.declared_titles(["13. 골절 진단비", "특별약관 ..... 12", "", "Ⅱ. 질병 관련 특별약관 ···· 3", "본문 한 줄 ..... 4"])
    assert got == ["골절진단비특별약관"]
    s = spark.createDataFrame([("d", "1. 골절 특약"), ("d", "기타"), ("d", None)], "doc_hash string, section string")
    assert [x.title for x in S.stored_titles(s).collect()] == ["골절특약"]


def fragment(page, text, seq=0, table=False):
    return {"doc_hash": "d", "page": page, "is_table": table, "seq": seq, "text": text}


def bound(page, label, kind, k=0):
    return {"ord": k, "page": page, "label": label, "kind": kind}


def test_articles_are_carried_and_guarded():
    b = [bound(1, "보통약관", "base")]
    got = S.label_rows([fragment(1, "제1조(목적) 가"), fragment(1, "이어지는 글", 1), fragment(1, "제2조(정의) 나\n제3조(지급) 다", 2), fragment(2, "제297조(강간) 라"), fragment(2, "| 제4조(표 안) | x |", 1, True), fragment(3, "마지막")], b)
    assert [(r["article_no"], r["article_title"]) for r in got] == [(1, "목적"), (1, "목적"), (2, "정의"), (3, "지급"), (3, "지급"), (4, "표 안"), (4, "표 안")]


def test_lists_of_citations_are_no_headings():
    assert len(S._cuts("제1조(가)\n제2조(나)\n제3조(다)\n본문")) == 1 and len(S._cuts("글\n제2조(나)\n제3조(다)\n글")) == 3
    assert len(S._cuts("다음 법률\n제5조(나) 글")) == 1 and len(S._cuts("글\n제2조(나)에서 정한")) == 1


def test_headings_over_lines_and_without_an_end():
    assert S.heading("제1조\n보험금의 지급\n본문") == (1, "보험금의 지급") and S.heading("제3조(암(유사암제외), 갑상선암 경계성종양의 정의") == (3, "암(유사암제외), 갑상선암 경계성종양의 정의")
    assert S.heading("제20조(특별부활(효\n력회복)) 본문") == (20, "특별부활(효 력회복)") and S.heading("제5조(가)에서 정한") is None and S.heading("본문") is None
    assert len(S._cuts("앞 글\n제20조(특별부활(효\n력회복))\n본문")) == 2 and len(S._cuts("제1관 일반사항 및 용어의 정의\n제1조(목적) 글")) == 2
    assert len(S._cuts("의료급여법\n제10조(부담) 글")) == 1 and len(S._cuts("다음과 같다,\n제2조(나) 글")) == 1
    assert len(S._cuts("제297조(가)\n\n제298조(나)\n제299조(다)\n본문")) == 1


def test_the_last_boundary_of_a_page_that_a_fragment_names_counts():
    b = [bound(1, "가나다 특별약관", "yak"), bound(1, "라마바 특별약관", "yak", 1), bound(1, "별표3 골절 분류표", "byeolpyo", 2)]
    got = S.label_rows([fragment(1, "앞 글"), fragment(1, "가나다 특별약관\n라마바 특별약관\n제1조(목적) 글", 1), fragment(1, "【 별표3 】 골절 분류표", 2), fragment(2, "3. 골절담보\n- 4 -\n뒤 글")], b)
    assert [r["section"] for r in got] == [None, "라마바 특별약관", "라마바 특별약관", "별표3 골절 분류표", "별표3 골절 분류표"] and got[-1]["text"] == "뒤 글"
    assert [r["article_no"] for r in got] == [None, None, 1, None, None]


def test_a_reset_begins_a_section():
    b = [bound(1, "묶음 특별약관", "yak")]
    f = [fragment(1, "묶음 특별약관\n제1조(가) 글"), fragment(1, "제2조(나) 글", 1), fragment(1, "제1조(가) 글", 2), fragment(2, "제2조(나) 글\n수술비 특별약관"), fragment(2, "제1조(다) 글", 1)]
    got = S.label_rows(f, b)
    assert [r["section"] for r in got] == ["묶음 특별약관", "묶음 특별약관", "묶음 특별약관 · 구분1", "묶음 특별약관 · 구분1", "수술비 특별약관"]
    assert "수술비" not in got[3]["text"]
    got = S.label_rows(f[:3], b, ["제1조(가)글의이름"[:6]])
    assert got[2]["section"] != "묶음 특별약관"


def test_label_articles_spreads_documents(spark):
    rows = [(d, 1, False, i, f"제{i + 1}조(가{i}) 글") for d in ("a", "b") for i in range(3)]
    f = spark.createDataFrame(rows, "doc_hash string, page int, is_table boolean, seq int, text string").repartition(4)
    b = spark.createDataFrame([("a", 0, 1, "보통약관", "base")], "doc_hash string, ord int, page int, label string, kind string")
    got = {(r.doc_hash, r.seq): (r.section, r.article_no) for r in S.label_articles(f, b).collect()}
    assert got["a", 2] == ("보통약관", 3) and got["b", 2] == (None, None)


def test_contents(spark):
    page = ["목차", "1. 골절진단비 특별약관 ···· 12", "화상진단비(감액없", "음) 특별약관 ..... 13", "상해입원일당 특별약관/골절수술비 특별약관", "14", "  깁스치료비 특별약관", "https://x.example ...... 3", "본문 줄"]
    want = ["골절진단비특별약관", "화상진단비(감액없음)특별약관", "상해입원일당특별약관", "골절수술비특별약관", "깁스치료비특별약관"]
    assert S.contents_titles(page) == want and S.contents_titles(page[:3]) == []
    df = spark.createDataFrame([line(p, t, no=i) for p in (1, 2) for i, t in enumerate(page)], SCHEMA)
    assert [r.title for r in S.contents(df).orderBy("ord").collect()] == want


def test_lines_in_tables_are_left_out(spark):
    boxes = spark.createDataFrame([("d", 1, 0.0, 0.0, 5.0, 5.0)], "doc_hash string, page int, x0 double, y0 double, x1 double, y1 double")
    df = spark.createDataFrame([line(1, "in"), line(2, "out")], SCHEMA)
    assert [r.text for r in S.in_boxes(df, boxes).collect()] == ["out"]


def test_lines_leave_in_one_stream_without_the_bounds_on_each(spark):
    rows = [(d, 1, False, i, f"제{i + 1}조(가{i}) 글") for d in ("a", "b", "c") for i in range(3)]
    f = spark.createDataFrame(rows, "doc_hash string, page int, is_table boolean, seq int, text string").repartition(4)
    b = spark.createDataFrame([("a", i, 1, f"보통약관{i}", "yak") for i in range(5)] + [("z", 0, 1, "다른 특별약관", "yak")], "doc_hash string, ord int, page int, label string, kind string")
    got = S.label_articles(f, b)
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString() and {r.doc_hash for r in got.collect()} == {"a", "b", "c"}


def test_a_text_is_read_once_and_all_its_signs_are_right():
    assert S.text_features("손해는 보상한다. 2. 화상진단비(감액없음) 특별약관")[0] == "2. 화상진단비(감액없음) 특별약관" and S.text_features("【별표 2】  가  나")[1] == "별표2 가 나"
    assert S.text_features("질병 분류표")[2] and S.text_features("특별약관 색인")[3] and S.text_features("특별약관")[8] and S.text_features("의료법 시행령")[7]
