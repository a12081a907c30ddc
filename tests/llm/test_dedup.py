import collections

import numpy as np

from quarry.llm import minhash as M
from quarry.llm import substring as S
from quarry.llm.common import text_words
from quarry.llm.graph import components


def test_components_of_paths_stars_and_loops(spark):
    e = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 110)] + [(7, 7), (None, 3), (200, 201), (201, 202), (202, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(e, "a long, b long"), local=0).collect()}
    assert got == {r.node: r.root for r in components(spark.createDataFrame(e, "a long, b long")).collect()}
    assert {got[i] for i in range(41)} == {0} and {got[i] for i in range(100, 110)} == {100} and got[202] == 200
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def sets(texts, k=3):
    out = []
    for t in texts:
        h = text_words(t)
        out.append(set(M.shingles(h, np.array([0, len(h)]), k)[0].tolist()))
    return out


def test_signatures_estimate_similarity_better_than_independent_hashes():
    rng = np.random.default_rng(3)
    errors = []
    for _ in range(60):
        a = rng.integers(0, 2**63, 60, dtype=np.uint64)
        b = np.concatenate((a[:40], rng.integers(0, 2**63, 20, dtype=np.uint64)))
        s = M.superminhash(np.concatenate((a, b)), np.array([0, 60, 120]))
        errors.append(M.estimate(s[:1], s[1:])[0] - 0.5)
    assert abs(np.mean(errors)) < 0.02 and np.var(errors) < 0.25 / 128


def test_signatures_do_not_depend_on_the_batch():
    h = np.arange(1, 50, dtype=np.uint64)
    one = M.superminhash(h[:10], np.array([0, 10]))
    many = M.superminhash(np.concatenate((h, h[:10], h[:3])), np.array([0, 49, 49, 59, 62]))
    assert np.array_equal(one[0], many[2]) and (many[1] == M._EMPTY).all() and (many[3] != M._EMPTY).all()


def test_near_groups_against_brute_force(spark, docs, sf):
    got = M.op6(spark, sf).toPandas()
    group = dict(zip(got.doc_id, got.group_id, strict=True))
    rows = docs.select("doc_id", "text").toPandas()
    s = dict(zip(rows.doc_id, sets(rows.text), strict=True))
    ids = sorted(s)
    sim = lambda a, b: len(s[a] & s[b]) / max(1, len(s[a] | s[b]))
    want = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if sim(a, b) >= M.THRESHOLD]
    found = sum(group.get(a, -1) == group.get(b, -2) for a, b in want)
    assert want and found >= 0.9 * len(want)
    for d in group:  # no clean document is in a group
        assert max(sim(d, x) for x in ids if x != d) > 0.4
    assert all((g == d) == k for d, g, k in zip(got.doc_id, got.group_id, got.kept, strict=True))
    assert M.deduplicate(docs).count() == len(ids) - (~got.kept).sum()


def test_pairs_at_the_threshold_are_judged_by_their_sets(spark):
    rows, like, unlike = [], [], []
    for i in range(60):  # 298 shingles each, of which 200 or 196 are common: 0.505 or 0.490
        k = 202 if i % 2 else 198
        rows += [(2 * i, " ".join(f"w{i}x{j}" for j in range(300))), (2 * i + 1, " ".join(f"w{i}x{j}" if j < k else f"v{i}x{j}" for j in range(300)))]
        (like if i % 2 else unlike).append(2 * i)
    got = {r.doc_id for r in M.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(d in got for d in like) >= 0.9 * len(like) and not got & set(unlike)


def test_groups_whose_least_document_is_unlike_the_rest(spark):
    base = [f"w{i}" for i in range(400)]
    rows = [(k, " ".join(base[: 400 - 40 * k])) for k in range(6)]
    got = {r.doc_id: r.group_id for r in M.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert set(got.values()) == {0} and len(got) == 6


def test_near_groups_of_odd_rows(odd, empty):
    got = {r.doc_id: r.group_id for r in M.near_groups(odd).collect()}
    assert not {1, 2, 3, 4, None} & set(got) and got[7] == got[8] == got[9] == 7 and got[11] == got[12] == 11 and 5 not in got
    left = M.deduplicate(odd)
    assert left.schema == odd.schema
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in left.collect()) == [(False, 0), *[(True, i) for i in (1, 2, 3, 4, 5, 6, 7, 10, 11)]]
    assert M.near_groups(empty).count() == 0 and M.deduplicate(empty).count() == 0


def test_every_pair_of_places_shares_an_anchor():
    mask = S.in_cover(S.PERIOD * 3)
    for i in range(S.PERIOD):
        for j in range(S.PERIOD):
            assert any(mask[i + d] and mask[j + d] for d in range(S.PERIOD))


def brute(rows, n=50):
    """Words of each document in runs of n words that occur elsewhere too, by whether the run is the first."""
    at = collections.defaultdict(set)
    for d, t in rows:
        h = text_words(t).tolist()
        for k in range(len(h) - n + 1):
            at[tuple(h[k : k + n])].add((d, k))
    out = collections.defaultdict(set)
    for places in at.values():
        if len(places) > 1:
            for p in places:
                out[p[0], p != min(places)].update(range(p[1], p[1] + n))
    return dict(out)


def spans(df):
    out = collections.defaultdict(set)
    for r in df.collect():
        out[r.doc_id, r.removed].update(range(r.start_word, r.end_word))
    return dict(out)


def test_repeated_spans_against_brute_force(spark, docs, sf):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute(rows)
    assert want and spans(S.op9(spark, sf)) == want


def test_repeats_of_awkward_lengths_and_places(spark):
    rng = np.random.default_rng(5)
    w = [f"t{i}" for i in rng.permutation(5000)]
    rows = [(i, " ".join(w[i * 97 : i * 97 + int(rng.integers(0, 60))] + w[4000 : 4000 + n] + w[i * 97 + 60 : i * 97 + 97])) for i, n in enumerate([49, 50, 51, 80, 81, 120, 50, 31, 200])]
    rows += [(50, " ".join(w[4500:4560] * 3)), (51, " ".join(w[4500:4560])), (52, " ".join(w[4500:4560]))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert spans(S.repeated_spans(df)) == brute(rows)


def test_repeats_in_odd_rows(odd, empty):
    want = brute([(r.doc_id, r.text) for r in odd.dropDuplicates(["doc_id"]).collect() if r.doc_id is not None])
    assert spans(S.repeated_spans(odd)) == want and (8, True) in want
    left = S.remove_repeats(odd)
    assert left.schema == odd.schema
    text = {r.doc_id: r for r in left.collect()}
    assert text[8].text == "d e " and text[8].n_chars == 4 and 9 not in text and text[7].text.startswith("a b passage0") and text[None].text.endswith("null id") and text[1].text is None
    assert S.repeated_spans(empty).count() == 0 and S.remove_repeats(empty).count() == 0


def test_shared_rows_are_found_across_batches():
    import pyarrow as pa

    rows = sorted([(5, d, p, False) for d, p in ((1, 2), (1, 9), (3, 0), (3, 0), (7, 7))] + [(1, 1, 1, False), (2, 4, 4, True), (8, 1, 3, False), (8, 1, 3, False), (9, 2, 2, False), (9, 2, 5, False)])
    want = {(1, 2, True), (1, 9, False), (3, 0, False), (7, 7, False), (4, 4, True), (2, 2, True), (2, 5, False)}
    for size in (1, 2, 3, 20):
        parts = [rows[i : i + size] for i in range(0, len(rows), size)]
        batches = [pa.record_batch({"hash": pa.array([r[0] for r in x], pa.int64()), "doc": pa.array([r[1] for r in x], pa.int64()), "place": pa.array([r[2] for r in x], pa.int32()), "twin": pa.array([r[3] for r in x])}) for x in parts]
        got = [tuple(r.values()) for b in S._shared(iter(batches)) for r in b.to_pylist()]
        assert sorted(got) == sorted(want), size


def test_rows_that_repeat_an_id_with_other_texts_are_one_whatever_their_order(spark):
    w = lambda s, n=60: " ".join(f"{s}{i}" for i in range(n))
    rows = [(5, w("b"), 1), (5, w("a"), 2), (5, w("a"), 1), (8, w("b"), 1), (9, w("a"), 1), (None, w("a"), 1), (None, w("a"), 1)]
    seen = []
    for order in (rows, rows[::-1], rows[3:] + rows[:3]):
        df = spark.createDataFrame(order, "doc_id long, text string, `n.o` int")
        seen.append((sorted(map(tuple, M.near_groups(df).collect())), sorted(map(str, M.deduplicate(df).collect()))))
    assert seen[0] == seen[1] == seen[2] and seen[0][0] == [(5, 5, True), (9, 5, False)]
    assert len(seen[0][1]) == 4 and sum("n.o=1" in x and "doc_id=5" in x for x in seen[0][1]) == 1


def test_a_document_in_many_pairs_is_dealt_into_parts(spark, monkeypatch):
    monkeypatch.setattr(M, "PART", 5)
    base = [f"w{i}" for i in range(200)]
    rows = [(k, " ".join([*base[:k], f"x{k}", *base[k + 1 :]])) for k in range(40)] + [(100, "none like it at all")]
    got = {r.doc_id: r.group_id for r in M.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == dict.fromkeys(range(40), 0)
