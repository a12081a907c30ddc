import random

import pytest

from quarry.llm import ctph as C
from quarry.llm import sharding as S


def cut_share(edges, shard):
    total = sum(w for _, _, w in edges)
    return sum(w for a, b, w in edges if shard[a] != shard[b]) / total


def test_shards_are_even_and_cut_fewer_links(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sizes, edges = S.links(docs)
    before = {r.doc: r.shard for r in S.deal(sizes, 8).collect()}
    rows = S.shard(docs, shards=8, rounds=6).collect()
    after = {r.doc_id: r.shard for r in rows}
    assert len(after) == len(rows) == docs.count()
    size = [sum(r["size"] for r in rows if r.shard == k) for k in range(8)]
    assert max(size) <= sum(size) / 8 * (1 + S.SLACK)
    e = [tuple(r) for r in edges.collect()]
    assert cut_share(e, after) < 0.6 * cut_share(e, before)


def test_weights_count_every_linked_pair(spark):
    family = lambda d: d * 7919 % 48
    rows = [(d, "\n".join(f"line {k} of the family number {family(d)} of copies" for k in range(3))) for d in range(960)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sizes, lines = S.members(df)
    dealt = S.deal(sizes, 4)
    start = {r.doc: r.shard for r in dealt.collect()}
    w = {(r.doc, r.shard): r.w for r in S.weights(lines, dealt).collect()}
    assert all(w.get((d, k), 0) == 3 * sum(start[x] == k and x != d for x, _ in rows if family(x) == family(d)) for d in range(0, 960, 37) for k in range(4))


def test_shards_of_odd_rows(odd, empty):
    got = S.shard(odd, shards=3, rounds=2)
    assert sorted(r.doc_id for r in got.collect()) == [*range(1, 13)] and got.where("shard < 0 or shard > 2 or shard is null").count() == 0
    assert S.shard(empty).count() == 0


def slow_distance(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        q = [i]
        for j, y in enumerate(b, 1):
            q.append(min(p[j] + 1, q[-1] + 1, p[j - 1] + (x != y)))
        p = q
    return p[-1]


def test_edit_distances():
    r = random.Random(4)
    make = lambda: bytes(r.choice(b"ABC") for _ in range(r.choice([0, 1, 5, 63, 64, 65, 130])))
    xs, ys = [make() for _ in range(60)], [make() for _ in range(60)]
    assert C.edit_distances(xs, ys).tolist() == [slow_distance(a, b) for a, b in zip(xs, ys, strict=True)]


def test_an_edit_changes_few_signs():
    import numpy as np

    r = random.Random(9)
    a = bytes(r.choice(b"abcdefghij ") for _ in range(20_000))
    b = a[:9_000] + b"something else" + a[9_000:]
    x, y = C.fingerprint(np.frombuffer(a, np.uint8)), C.fingerprint(np.frombuffer(b, np.uint8))
    as_text = lambda f: (f[0], f[1].decode(), f[2].decode())
    assert C.compare([as_text(x)], [as_text(y)])[0] > 80
    # pieces that go over the stretches in which they are hashed
    c = np.frombuffer(a * 30, np.uint8)
    assert len(C.signature(c, C.rolling(c), 3 * 2**14)) >= 1


def links_of(rows):
    """Every link of the result, once what its rows say of them is seen to agree."""
    links = [(r.doc_id, x.match_id, x.score) for r in rows for x in r.links or []]
    of = {}
    for a, b, s in links:
        of.setdefault(a, []).append((-s, b))
        of.setdefault(b, []).append((-s, a))
    for r in rows:
        if r.doc_id != r.class_id:
            assert (r.n_links, r.match_id, r.score, r.links) == (1, r.class_id, 100, None)
            links.append((r.doc_id, r.class_id, 100))
        else:
            assert r.n_links == len(of.get(r.doc_id, [])) and ((-r.score, r.match_id) == min(of[r.doc_id]) if r.n_links else r.match_id is None)
    return sorted(links)


def all_links(prints, classes):
    """Links by brute force: of all pairs of representatives, and of each other document to its own."""
    reps = sorted(set(classes.values()))
    pairs = [(b, a) for i, a in enumerate(reps) for b in reps[i + 1 :]]
    scores = C.compare([prints[a] for a, _ in pairs], [prints[b] for _, b in pairs])
    return sorted([(a, b, int(s)) for (a, b), s in zip(pairs, scores, strict=True) if s >= C.MATCH] + [(d, r, 100) for d, r in classes.items() if d != r])


def classes_of(prints):
    least = {}
    for d in sorted(prints):
        least.setdefault(prints[d] if prints[d][1] else d, d)
    return {d: least[prints[d] if prints[d][1] else d] for d in prints}


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_matches_against_all_pairs(which, request):
    df = request.getfixturevalue(which)
    got = C.matches(df).collect()
    prints = {r.doc_id: (r.block, r.sig, r.sig2) for r in C.fingerprints(df).collect()}
    classes = classes_of(prints)
    assert links_of(got) == all_links(prints, classes) != []
    assert {r.doc_id: r.class_id for r in got} == classes and len(got) == len(classes)
    assert all(r.fingerprint == "{}:{}:{}".format(*prints[r.doc_id]) for r in got)


@pytest.mark.parametrize("block", [3, 25, 2000])
def test_large_families_of_near_copies_keep_every_link(spark, block):
    r = random.Random(7)
    base = ["".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(500)]
    rows = []
    for k in range(70):  # more than are paired one by one, and more than a block
        w = list(base)
        for _ in range(3):
            w[r.randrange(500)] = f"edit{r.randrange(10**6)}"
        rows.append((k, " ".join(w)))
    rows += [(100 + k, rows[k % 70][1]) for k in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    prints = {x.doc_id: (x.block, x.sig, x.sig2) for x in C.fingerprints(df).collect()}
    assert links_of(C.matches(df, block=block).collect()) == all_links(prints, classes_of(prints))


def test_families_of_copies_that_are_near_copies_of_each_other(spark):
    r = random.Random(2)
    a = " ".join("".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(600))
    b, c = a[:1500] + " another passage here " + a[1500:], a[:3000] + " one more change " + a[3000:]
    df = spark.createDataFrame([(1, a), (2, a), (3, b), (4, b), (5, c), (6, "x"), (7, None), (8, "")], "doc_id long, text string")
    got = C.matches(df).collect()
    assert {(x, y) for x, y, _ in links_of(got)} == {(2, 1), (4, 3), (3, 1), (5, 1), (5, 3)}
    assert {x.doc_id: x.class_id for x in got} == {1: 1, 2: 1, 3: 3, 4: 3, 5: 5, 6: 6, 7: 7, 8: 8}


def test_a_repeated_id_is_one_document_by_its_least_fingerprint(spark):
    r = random.Random(3)
    t = [" ".join("".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(400)) for _ in range(2)]
    rows = [(1, t[0]), (1, t[1]), (2, t[0]), (3, t[1])]
    got = [sorted(map(str, C.matches(spark.createDataFrame(o, "doc_id long, text string")).collect())) for o in (rows, rows[::-1])]
    assert got[0] == got[1] and len(got[0]) == 3


def test_matches_of_nothing(empty):
    assert C.matches(empty).count() == 0
