import numpy as np
from pyspark.sql import functions as F

from quarry.llm import langid as L
from quarry.llm import quality as Q
from quarry.llm import toxicity as T


def test_codewords_differ_in_several_bits():
    for k in (2, 3, 4, 6, 9):
        c = L.codewords(k)
        assert c.shape[0] == k and (np.abs(c.sum(0)) < k).all()
        apart = min((c[i] != c[j]).sum() for i in range(k) for j in range(i))
        assert apart >= (1 if k == 2 else 2)


def test_decoding_mends_a_wrong_bit_and_flags_ties():
    c = L.codewords(4)
    f = 3.0 * c.copy()
    f[:, 0] *= -1
    best, margin = L.decode(f, c, np.ones(c.shape[1]))
    assert best.tolist() == [0, 1, 2, 3] and (margin > 0).all()
    best, margin = L.decode(np.zeros((1, c.shape[1])), c, np.ones(c.shape[1]))
    assert margin[0] == 0 and best[0] == 0  # the first in the alphabet


def test_decoding_against_a_search_of_all_codewords():
    rng = np.random.default_rng(6)
    for k in (2, 3, 5, 9):
        c = L.codewords(k)
        f, a = rng.normal(0, 2, (50, c.shape[1])), rng.random(c.shape[1])
        best, margin = L.decode(f, c, a)
        for x, i, m in zip(f, best, margin, strict=True):
            loss = sorted((sum(a[b] * np.log1p(np.exp(-x[b] * c[j, b])) for b in range(c.shape[1])), j) for j in range(k))
            assert loss[0][1] == i and abs((loss[1][0] - loss[0][0]) / a.sum() - m) < 1e-9


def test_language_of_held_out_documents(spark, docs, sf):
    got = {r.doc_id: r.lang for r in L.identify(docs, train_docs=120).collect()}
    truth = {r.doc_id: r.lang for r in docs.collect()}
    assert len(got) == len(truth) and np.mean([got[d] == v for d, v in truth.items()]) > 0.95


def test_a_language_outside_the_first_documents_is_known(spark, docs):
    word = lambda i, j: "".join("qxzjkvw"[(i * 31 + j * 17 + n * (j + 3)) % 7] for n in range(6))
    late = [r.id for r in spark.range(10_000, 10_200).orderBy(F.desc(F.xxhash64("id"))).limit(5).collect()]
    rare = spark.createDataFrame([(d, " ".join(word(i, j) for j in range(80)), "rare") for i, d in enumerate(late)], "doc_id long, text string, lang string")
    both = docs.select("doc_id", "text", "lang").unionByName(rare)
    first = both.select("doc_id", "lang").orderBy(F.xxhash64("doc_id"), "doc_id").limit(20).collect()
    assert "rare" not in {r.lang for r in first}
    got = {r.doc_id: r.lang for r in L.identify(both, train_docs=20).collect()}
    assert [got[d] for d in late] == ["rare"] * 5


def test_language_of_odd_rows(odd, empty, spark):
    got = {r.doc_id: r for r in L.identify(odd).collect()}
    assert got[1].lang is None and got[1].ambiguous and got[4].ambiguous and got[7].lang == "en" and None not in got
    assert L.identify(empty).count() == 0
    none = L.identify(odd.drop("lang").selectExpr("*", "cast(null as string) lang"))
    assert none.where("lang is not null or not ambiguous").count() == 0


def test_quality_of_held_out_labels(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    half = F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(2)) == 0
    got = {r.doc_id: r.keep for r in Q.score(docs, labels.where(half)).collect()}
    held = {r.doc_id: r.quality for r in labels.where(~half).collect()}
    assert np.mean([not got[k] for k, v in held.items() if v == 0]) > 0.93 and np.mean([got[k] for k, v in held.items() if v > 0]) > 0.99


def test_pseudo_labels_against_a_full_sort(spark):
    rng = np.random.default_rng(8)
    rows = [(i, float(t), float(m)) for i, (t, m) in enumerate(np.round(rng.normal(0, 5, (300, 2)), 1))] + [(400, 9.0, 9.0), (400, 8.0, 8.0), (401, 9.0, 9.0)]
    s = spark.createDataFrame(rows, "doc_id long, t double, m double")
    best = {}
    for d, t, m in rows:
        for k, v in (("t", t), ("m", m)):
            best.setdefault((d, k), []).append((v, m if k == "t" else t))
    want = {"t": {}, "m": {}}
    for mine, other in (("t", "m"), ("m", "t")):
        for good in (1, -1):
            able = {d: max(v * good for v, o in x if v * good >= 3 and o * good > -3) for (d, k), x in best.items() if k == mine and any(v * good >= 3 and o * good > -3 for v, o in x) and d not in (5, 400)}
            for d in sorted(able, key=lambda d: (-able[d], d))[:20]:
                want[other].setdefault(d, float(good > 0))
    got = Q.choose(s, 3.0, 20, {5, 400})
    assert {v: set(x) for v, x in got.items()} == {v: set(x) for v, x in want.items()}


def test_quality_of_odd_rows(odd, empty, labels, spark, docs):
    s = Q.score(odd, labels)
    assert s.count() == odd.count() and s.where("p_quality is null").count() == 0
    kept = Q.keep_good(odd, labels)
    assert kept.schema == odd.schema
    assert Q.score(odd, labels.limit(0)).where("p_quality < 1 or not keep").count() == 0
    assert Q.score(empty, labels).count() == 0 and Q.score(odd.select("doc_id", "text"), labels).count() == odd.count()
    many = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    assert Q.keep_good(docs, many).schema == docs.schema


def test_label_model_finds_accuracies_and_doubles():
    rng = np.random.default_rng(2)
    y = rng.random(20000) < 0.1
    votes = np.zeros((20000, 6), int)
    for k, (hit, false) in enumerate([(0.9, 0.01), (0.6, 0.02), (0.7, 0.02), (0.8, 0.02), (0.5, 0.05)]):
        votes[:, k] = rng.random(20000) < np.where(y, hit, false)
    votes[:, 5] = votes[:, 4]
    u, n = np.unique(votes, axis=0, return_counts=True)
    m = T.LabelModel(u, n)
    assert abs(m.share - 0.1) < 0.06 and m.correlation[4, 5] > 0.5 and m.damp[4] > 1.5
    p = m.posterior(votes)
    assert ((p > 0.5) == y).mean() > 0.94


def test_voters(spark):
    import pyarrow as pa

    from quarry.llm.common import buffers

    v = T.Voters(np.sort(np.unique(T.text_words("zzgrob"))))
    texts = ["", None, "you are an IDIOT", "the animals ran", "sh1t", "go to hell, worthless scum", "zzgrob", "clean words only"]
    got = v.votes(*buffers(pa.array(texts, pa.string())))
    name = dict(zip(T.VOTERS, range(len(T.VOTERS)), strict=True))
    assert got[2, name["insult"]] == 1 and got[2, name["aimed"]] == 1 and got[3].max() == 0 and got[4, name["disguised"]] == 1
    assert got[5, name["phrase"]] == 1 and got[5, name["several"]] == 1 and got[6, name["mined"]] == 1 and not got[[0, 1, 7]].any()
    assert (T.unpack(T.pack(got)) == got).all()


def test_toxicity_of_held_out_labels_by_language(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    half = F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(2)) == 0
    got = {r.doc_id: r.toxic for r in T.score(docs, labels.where(half)).collect()}
    assert len(got) == docs.count()
    held = labels.where(~half).join(docs, "doc_id").select("doc_id", "lang", "toxic").collect()
    share = lambda toxic, lang: np.mean([got[r.doc_id] for r in held if r.toxic == toxic and lang in (None, r.lang)])
    assert share(1, "en") > 0.9 and share(1, "de") > 0.6 and share(1, "fr") > 0.5 and share(0, None) < 0.005


def test_label_model_against_enumeration():
    rng = np.random.default_rng(4)
    votes = (rng.random((400, 4)) < 0.3).astype(int)
    votes[:200, 3] = -1  # not asked
    u, n = np.unique(votes, axis=0, return_counts=True)
    m = T.LabelModel(u, n)
    for v in u:
        p = [np.log(1 - m.share), np.log(m.share)]
        for k in range(4):
            if v[k] >= 0:
                a, b = (m.table[y, k, v[k] + 1] for y in (0, 1))
                gain = np.log(b / a)
                p[1] += (max(gain, 0) if v[k] else min(gain, 0)) / m.damp[k]
        assert abs(m.posterior(v[None])[0] - 1 / (1 + np.exp(p[0] - p[1]))) < 1e-9


def test_toxicity_of_odd_rows(odd, empty, labels):
    got = T.score(odd, labels)
    assert got.count() == odd.where("doc_id is not null").count() and got.where("toxic").count() == 0
    assert T.score(empty, labels).count() == 0
