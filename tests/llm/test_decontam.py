import duckdb
import numpy as np

from quarry.llm import decontam as D


def test_index_counts_and_locates_like_a_scan():
    rng = np.random.default_rng(1)
    for top in (1, 3, 40):
        x = rng.integers(0, top + 1, 700)
        x[100:180] = x[300:380]
        x[-1] = 0
        fm = D.FMIndex(x, top)
        pats = [x[i : i + k][::-1] for i in range(0, 690, 7) for k in (1, 2, 5, 8) if (x[i : i + k] > 0).all()]
        size = np.array([len(p) for p in pats])
        m = np.zeros((len(pats), 8), np.int64)
        for i, p in enumerate(pats):
            m[i, : len(p)] = p
        lo, hi = fm.search(m, size)
        for i, p in enumerate(pats):
            want = [k for k in range(len(x) - len(p) + 1) if np.array_equal(x[k : k + len(p)], p[::-1])]
            assert sorted(fm.locate(np.arange(lo[i], hi[i])).tolist()) == want


def frame(x):
    return sorted(map(tuple, x.toPandas().itertuples(index=False, name=None)))


def test_query_against_sql(spark, sf):
    c = duckdb.connect()
    for t in ("documents", "benchmark"):
        c.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    assert frame(D.op2(spark, sf)) == sorted(c.execute(D.SQL2).fetchall()) != []


def test_slices_of_a_large_benchmark_give_the_same(spark, sf):
    d, b = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    assert frame(D.leak_spans(d, b, slice_words=200)) == frame(D.leak_spans(d, b))


def test_leaks_of_items_in_several_slices_are_cut_whole(spark):
    w = [f"leak{i}" for i in range(36)]
    bench = spark.createDataFrame([(i, " ".join(w[i : i + 8])) for i in range(0, 29, 4)], "item_id long, text string")
    df = spark.createDataFrame([(1, "before it " + " ".join(w) + " after it"), (None, " ".join(w[4:16]) + " x"), (2, " ".join(w)), (3, "none")], "doc_id long, text string")
    assert len(list(D._slices(bench, 20))) > 2
    got = sorted(r.text for r in D.remove_leaks(df, bench, slice_words=20).collect())
    assert got == sorted(r.text for r in D.remove_leaks(df, bench).collect()) == [" x", "before it  after it", "none"]


def test_odd_rows(spark, odd, empty):
    words = [f"passage{i}" for i in range(60)]
    bench = spark.createDataFrame([(1, " ".join(words[10:30])), (None, "x x x x x"), (2, None), (3, ""), (4, "one"), (5, " ".join(words[25:40]))], "item_id long, text string")
    got = frame(D.leak_spans(odd, bench).fillna(-1))
    assert got == [(7, 12, 42, 1), (8, 12, 42, 1), (9, 10, 40, 1), (11, 0, 300, -1), (12, 0, 300, -1)]
    left = D.remove_leaks(odd, bench)
    assert left.schema == odd.schema
    text = {r.doc_id: r for r in left.collect()}
    assert 11 not in text and text[9].text == " ".join(words[:10]) + "  " + " ".join(words[40:]) and text[9].n_chars == len(text[9].text)
    assert text[1].text is None and text[10].n_chars is None and "passage15" not in text[None].text
    assert D.leak_spans(empty, bench).count() == 0 and D.leak_spans(odd, bench.limit(0)).count() == 0 and D.remove_leaks(odd, bench.limit(0)).count() == odd.count()
