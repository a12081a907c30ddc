"""Document fingerprints by context-triggered piecewise hashing, and the matches of each document.

A rolling hash of the last WINDOW bytes ends a piece wherever it is block - 1 modulo the block size; a piece's hash gives
one of 64 signs. A document's block size is the greatest of 3 * 2**k at which its signature has at least
SIGNS / 2 signs (the least one if there is none), and the fingerprint holds the signatures at that size and at twice it, of
whole texts, however long. Two fingerprints are compared at each block size that both have: if their signatures share a run of
RUN signs (runs of more than three equal signs count as three), the score is 100 less the share of the edit distance in
the sum of their lengths, else 0; the best of the sizes counts. Edit distances are bit-parallel (Myers 1999, in Hyyro's form
for whole strings), of many pairs side by side.

Documents of one fingerprint are a class, and the one with the least doc_id represents it. Candidates are found exactly: a
representative is keyed by all the runs of its signatures (a key is the run itself and its block size, so none collide), and the
keys are sorted together once, 16 bytes each. Only the rows of runs that several have go on, with their signatures; where more
than BLOCK have one, they are dealt into blocks, and each pair of blocks is a group of its own, so that a hot run spreads over
tasks and no group has more than two blocks of rows. A pair that shares many runs is scored at the first of them alone, which both
signatures tell without a shuffle, so pairs are never shuffled, nor made twice.

Defined results: a text of fewer than RUN signs at its least block size (null and empty ones too) has a fingerprint and no match,
but for documents of the same nonempty fingerprint, which match with 100; documents with an empty one are each a class of their own;
rows without a doc_id are left out; rows that repeat a doc_id are one document, by its least fingerprint. The score of a pair is
the same in any order, so there are no ties to break. Columns but doc_id and text are not looked at, whatever their names. An empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.common import docs_of, mix, powers, release, steps, whole_groups
from quarry.session import cut, drop_cut, ship_package

WINDOW = 7
SIGNS = 64
RUN = 7
LEAST_BLOCK = 3
#: The lowest score that is a match.
MATCH = 40
#: Most rows in a block of the documents that share a run.
BLOCK = 1000
_SMALL = 32
_ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
_CODE = np.zeros(256, np.uint8)
_CODE[_ALPHABET] = np.arange(SIGNS)
_LUT = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def rolling(b: np.ndarray) -> np.ndarray:
    """Hash of the WINDOW bytes that end at each byte (fewer at the beginning): their sum, their sum weighted by recency, and a shifted exclusive or, as in spamsum."""
    n = len(b)
    x = b.astype(np.uint32)
    h1, h2, h3 = np.zeros(n, np.uint32), np.zeros(n, np.uint32), np.zeros(n, np.uint32)
    for j in range(min(WINDOW, n)):
        part = x[: n - j]
        h1[j:] += part
        h2[j:] += part * np.uint32(WINDOW - j)
        h3[j:] ^= part << np.uint32(5 * j if j < 6 else 30)
    return h1 + h2 + h3


def signature(b: np.ndarray, roll: np.ndarray, block: int) -> np.ndarray:
    """Signs of the pieces of a text at a block size."""
    if not len(b):
        return np.zeros(0, np.uint8)
    end = np.flatnonzero(roll % np.uint32(block) == block - 1) + 1
    start = np.concatenate(([0], end))
    if start[-1] == len(b):
        start = start[:-1]
    piece = np.zeros(len(start), np.uint64)
    step = 1 << 18
    for lo in range(0, len(b), step):  # by stretches, so that the tables of powers stay small; a piece's hash is the sum over its stretches
        hi = min(len(b), lo + step)
        i, j = np.searchsorted(start, lo, "right") - 1, np.searchsorted(start, hi, "left")
        at = np.maximum(start[i:j], lo) - lo
        v = _LUT[b[lo:hi]] * powers(hi - lo)[: hi - lo]
        s = np.add.reduceat(v, at) * powers(hi - lo, True)[at]
        piece[i:j] += mix(s + (np.maximum(lo - start[i:j], 0)).astype(np.uint64))
    return _ALPHABET[(mix(piece) >> np.uint64(58)).astype(np.int64)]


def fingerprint(b: np.ndarray) -> tuple[int, bytes, bytes]:
    """Block size, and the signatures at it and at twice it."""
    roll = rolling(b)
    block = LEAST_BLOCK
    while block * SIGNS < len(b):
        block *= 2
    double = None
    while True:
        sig = signature(b, roll, block)
        if block == LEAST_BLOCK or len(sig) >= SIGNS // 2:
            break
        double = sig
        block //= 2
    if double is None:
        double = signature(b, roll, block * 2)
    return block, sig.tobytes(), double.tobytes()


def shorten(s: np.ndarray) -> np.ndarray:
    """Runs of more than three equal signs, cut to three."""
    if len(s) < 4:
        return s
    keep = np.ones(len(s), bool)
    keep[3:] = ~((s[3:] == s[2:-1]) & (s[3:] == s[1:-2]) & (s[3:] == s[:-3]))
    return s[keep]


def signs_of(sigs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Signs (0 to 63) of all signatures one after another, runs of more than three cut to three, and where each begins, with the end."""
    flat = _CODE[np.frombuffer(b"".join(sigs), np.uint8)]
    size = np.array([len(x) for x in sigs], np.int64)
    owner = np.repeat(np.arange(len(sigs)), size)
    keep = np.ones(len(flat), bool)
    if len(flat) > 3:
        keep[3:] = ~((flat[3:] == flat[2:-1]) & (flat[3:] == flat[1:-2]) & (flat[3:] == flat[:-3]) & (owner[3:] == owner[:-3]))
    return flat[keep], np.concatenate(([0], np.cumsum(np.bincount(owner[keep], minlength=len(sigs)))))


def run_keys(flat: np.ndarray, at: np.ndarray, levels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the signature and key of each run of RUN signs, in order and once each; a key holds the run (6 bits a sign) below its level (block size 3 * 2**level)."""
    n = max(0, len(flat) - RUN + 1)
    x = flat.astype(np.int64)
    h = np.zeros(n, np.int64)
    for j in range(RUN):
        h = (h << 6) | x[j : j + n]
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))[:n]
    ok = np.arange(n) + RUN <= at[owner + 1]
    owner, h = owner[ok], h[ok] | (levels[owner[ok]] << (6 * RUN))
    order = np.lexsort((h, owner))
    owner, h = owner[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return owner[new], h[new]


def level_of(block: np.ndarray) -> np.ndarray:
    return np.round(np.log2(np.maximum(block, LEAST_BLOCK) / LEAST_BLOCK)).astype(np.int64)


def distances(flat: np.ndarray, at: np.ndarray, x: np.ndarray, y: np.ndarray, most: int = 8192) -> np.ndarray:
    """Levenshtein distance of each pair (x, y) of the strings whose signs are in flat from at on; strings of any length, in words of 64 signs."""
    size = np.diff(at)
    swap = size[x] > size[y]
    pat, txt = np.where(swap, y, x), np.where(swap, x, y)
    out = size[txt].copy()
    order = np.lexsort((size[txt], (size[pat] + 63) >> 6))
    order = order[size[pat[order]] > 0]
    lo = 0
    while lo < len(order):
        words = int(size[pat[order[lo]]] + 63) >> 6
        step = max(1, most // words)
        part = order[lo : lo + step]
        words = int(size[pat[part[-1]]] + 63) >> 6
        lo += step
        u, row = np.unique(pat[part], return_inverse=True)
        peq = np.zeros(words * len(u) * 64, np.uint64)
        n = size[u]
        which = np.repeat(np.arange(len(u)), n)
        j = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        np.add.at(peq, (((j >> 6) * len(u) + which) << 6) + flat[at[u][which] + j], np.uint64(1) << (j & 63).astype(np.uint64))
        peq = peq.reshape(words, -1)
        t, trow = np.unique(txt[part], return_inverse=True)
        width = size[t]
        text = np.zeros((len(t), max(1, int(width.max()))), np.int64)
        which = np.repeat(np.arange(len(t)), width)
        j = np.arange(len(which)) - np.repeat(np.cumsum(width) - width, width)
        text[which, j] = flat[at[t][which] + j]
        by_len = np.argsort(size[txt[part]], kind="stable")
        part, row, trow = part[by_len], row[by_len], trow[by_len]
        text = np.ascontiguousarray(text[trow].T)
        out[part] = _myers(peq, row.astype(np.int64) << 6, text, size[pat[part]], size[txt[part]], words)
    return out


def _myers(peq: np.ndarray, row: np.ndarray, text: np.ndarray, lp: np.ndarray, lt: np.ndarray, words: int) -> np.ndarray:
    """Distances of pairs in the order of their texts' lengths; text: signs by pairs."""
    one, top = np.uint64(1), np.uint64(63)
    n = len(row)
    pv, mv = np.full((words, n), ~np.uint64(0)), np.zeros((words, n), np.uint64)
    score = lp.astype(np.int64).copy()
    last, bit = (lp - 1) >> 6, ((lp - 1) & 63).astype(np.uint64)
    for j in range(int(lt[-1]) if n else 0):
        k = int(np.searchsorted(lt, j, "right"))
        r, c = row[k:], text[j, k:]
        plus, minus = np.ones(n - k, np.uint64), np.zeros(n - k, np.uint64)
        for w in range(words):
            eq, p, m = peq[w][r + c], pv[w, k:], mv[w, k:]
            xv = eq | m
            eq |= minus
            xh = (((eq & p) + p) ^ p) | eq
            ph, mh = m | ~(xh | p), p & xh
            at = slice(None) if words == 1 else last[k:] == w
            b = bit[k:][at]
            score[k:][at] += ((ph[at] >> b) & one).astype(np.int64) - ((mh[at] >> b) & one).astype(np.int64)
            up, down = ph >> top, mh >> top
            ph, mh = (ph << one) | plus, (mh << one) | minus
            plus, minus = up, down
            pv[w, k:], mv[w, k:] = mh | ~(xv | ph), ph & xv
    return score


def edit_distances(xs: list[bytes], ys: list[bytes]) -> np.ndarray:
    """Levenshtein distance of each pair of strings of signs."""
    flat = _CODE[np.frombuffer(b"".join([*xs, *ys]), np.uint8)]
    at = np.concatenate(([0], np.cumsum([len(s) for s in [*xs, *ys]], dtype=np.int64)))
    return distances(flat, at, np.arange(len(xs)), np.arange(len(xs), len(xs) + len(ys)))


class Sharing:
    """Which of some fingerprints share which runs."""

    def __init__(self, block: np.ndarray, sig: list[str], sig2: list[str]) -> None:
        both = [x.encode() for pair in zip(sig, sig2, strict=True) for x in pair]  # signature 2 * i and 2 * i + 1 of fingerprint i
        self.block = block
        self.flat, self.at = signs_of(both)
        level = level_of(block)
        owner, key = run_keys(self.flat, self.at, np.stack((level, level + 1), 1).reshape(-1))
        self.keys, rank = np.unique(key, return_inverse=True)
        self.radix = max(1, len(self.keys))
        self.level = self.keys >> (6 * RUN)
        order = np.lexsort((rank, owner >> 1))
        self.rank = rank[order]
        self.code = (owner[order] >> 1) * self.radix + self.rank  # fingerprint and run, in order; a fingerprint's two levels differ, so no run is there twice
        self.ptr = np.searchsorted(self.code, np.arange(len(block) + 1) * self.radix)

    def any_between(self, x: np.ndarray, y: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Of pairs of fingerprints, whether y has one of the runs at the places lo to hi of x's."""
        n = hi - lo
        hit = np.zeros(len(x), bool)
        some = np.flatnonzero(n > 0)
        for k in range(0, len(some), 20_000):
            s = some[k : k + 20_000]
            c = n[s]
            first = np.cumsum(c) - c
            at = np.arange(int(c.sum())) - np.repeat(first - lo[s], c)
            want = np.repeat(y[s] * self.radix, c) + self.rank[at]
            found = self.code[np.minimum(np.searchsorted(self.code, want), len(self.code) - 1)] == want
            hit[s] = np.logical_or.reduceat(found, first)
        return hit

    def earlier(self, x: np.ndarray, y: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Of pairs that share the run of that rank, whether they share one before it."""
        return self.any_between(x, y, self.ptr[x], np.searchsorted(self.code, x * self.radix + rank))

    def apart_before(self, x: np.ndarray, y: np.ndarray, rank: int) -> tuple[np.ndarray, np.ndarray]:
        """All pairs of one of x and one of y that share no run before that rank, by matrix products; if y is x, each pair once."""
        same = y is x
        owner = [np.repeat(np.arange(len(v)), self.ptr[v + 1] - self.ptr[v]) for v in (x, y)]
        ranks = [np.concatenate([self.rank[self.ptr[i] : self.ptr[i + 1]] for i in v]) for v in (x, y)]
        ok = [r < rank for r in ranks]
        owner, ranks = [o[k] for o, k in zip(owner, ok, strict=True)], [r[k] for r, k in zip(ranks, ok, strict=True)]
        u, n = np.unique(ranks[0], return_counts=True)
        u = u[n > 1] if same else np.intersect1d(u, ranks[1])
        total = np.zeros((len(x), len(y)), np.float32)
        for k in range(0, len(u), 2048):
            part = u[k : k + 2048]
            m = []
            for o, r, v in zip(owner, ranks, (x, y), strict=True):
                i = np.minimum(np.searchsorted(part, r), len(part) - 1)
                hit = part[i] == r
                a = np.zeros((len(v), len(part)), np.float32)
                a[o[hit], i[hit]] = 1
                m.append(a)
            total += m[0] @ m[1].T
        i, j = np.nonzero(np.triu(total == 0, 1) if same else total == 0)
        return x[i], y[j]

    def scores(self, x: np.ndarray, y: np.ndarray, level: np.ndarray) -> np.ndarray:
        """Scores of pairs whose first shared run is at that level."""
        mine, theirs = level_of(self.block[x]), level_of(self.block[y])

        def at(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            d = distances(self.flat, self.at, a, b)
            size = np.diff(self.at)
            return 100 - (100 * d) // np.maximum(size[a] + size[b], 1)

        best = at(2 * x + (level > mine), 2 * y + (level > theirs))
        again = np.flatnonzero((mine == theirs) & (level == mine))  # both have the next level too
        if len(again):
            a, b = x[again], y[again]
            more = at(2 * a + 1, 2 * b + 1)
            up = np.flatnonzero(more > best[again])
            a, b = a[up], b[up]
            start = np.searchsorted(self.code, a * self.radix + np.searchsorted(self.level, mine[again[up]] + 1))
            share = self.any_between(a, b, start, self.ptr[a + 1])
            best[again[up[share]]] = more[up[share]]
        return best


def _pairs(least: int, most: int = 500_000):
    """Links between representatives, each at its first shared run, by document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, ("key", "i", "j")):
            held: list[tuple] = []
            for part in _links(t, least):
                held.append(part)
                if sum(len(x[0]) for x in held) > most:
                    yield _by_document(held)
                    held = []
            if held:
                yield _by_document(held)
        release()

    return run


def _links(t: pa.Table, least: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(greater doc_id, lesser, score) of the links of some groups."""
    key, i, j, side, doc = (t.column(c).to_numpy() for c in ("key", "i", "j", "side", "doc_id"))
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, len(key)))
    docs, first, row = np.unique(doc, return_index=True, return_inverse=True)
    f = Sharing(t.column("block").to_numpy()[first], t.column("sig").take(pa.array(first)).to_pylist(), t.column("sig2").take(pa.array(first)).to_pylist())
    rank = np.searchsorted(f.keys, key)

    def scored(x: np.ndarray, y: np.ndarray, level: np.ndarray) -> Iterator[tuple]:
        for k in range(0, len(x), 100_000):
            p, q = x[k : k + 100_000], y[k : k + 100_000]
            score = f.scores(p, q, level[k : k + 100_000])
            ok = score >= least
            if ok.any():
                a, b = docs[p[ok]], docs[q[ok]]
                yield np.maximum(a, b), np.minimum(a, b), score[ok].astype(np.int32)

    for n in np.unique(size[size <= _SMALL]):
        p, q = np.triu_indices(n, 1)
        s = start[size == n]
        per = max(1, 100_000 // max(1, len(p)))
        for k in range(0, len(s), per):
            x, y = (s[k : k + per, None] + p).reshape(-1), (s[k : k + per, None] + q).reshape(-1)
            ok = (i[x] == j[x]) | (side[x] != side[y])
            x, y = x[ok], y[ok]
            ok = ~f.earlier(row[x], row[y], rank[x])
            yield from scored(row[x[ok]], row[y[ok]], f.level[rank[x[ok]]])
    for s, n in zip(start[size > _SMALL], size[size > _SMALL], strict=True):
        members, part = row[s : s + n], side[s : s + n]
        a = members if i[s] == j[s] else members[part == 0]
        x, y = f.apart_before(a, a if i[s] == j[s] else members[part == 1], int(rank[s]))
        yield from scored(x, y, np.full(len(x), f.level[rank[s]]))


_BY_DOCUMENT = "doc_id long, n long, best struct<score:int,minus:long>, links array<struct<match_id:long,score:int>>"


def _by_document(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """Of links, a row for each document: how many it has, its best, and those to lesser documents."""
    a, b, s = (np.concatenate(x) for x in zip(*held, strict=True))
    doc, other, score = np.concatenate((a, b)), np.concatenate((b, a)), np.concatenate((s, s))
    order = np.lexsort((other, -score, doc))
    u, first, n = np.unique(doc[order], return_index=True, return_counts=True)
    best = pa.StructArray.from_arrays([pa.array(score[order][first]), pa.array(-other[order][first])], ["score", "minus"])
    down = np.lexsort((b, a))
    at = np.concatenate(([0], np.cumsum(np.bincount(np.searchsorted(u, a), minlength=len(u))))).astype(np.int32)
    links = pa.ListArray.from_arrays(pa.array(at), pa.StructArray.from_arrays([pa.array(b[down]), pa.array(s[down])], ["match_id", "score"]))
    return pa.record_batch({"doc_id": u, "n": n, "best": best, "links": links})


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, b, o in steps(batches):
        rows = [fingerprint(b[i:j]) for i, j in zip(o[:-1], o[1:], strict=True)]
        yield pa.record_batch({"doc_id": batch.column(0), "block": pa.array([r[0] for r in rows], pa.int64()), "sig": pa.array([r[1].decode() for r in rows]), "sig2": pa.array([r[2].decode() for r in rows])})


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows == 0:
            continue
        both = [x.encode() for pair in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True) for x in pair]
        level = level_of(batch.column(1).to_numpy())
        owner, key = run_keys(*signs_of(both), np.stack((level, level + 1), 1).reshape(-1))
        yield pa.record_batch({"key": key, "doc": batch.column(0).to_numpy()[owner >> 1]})


def compare(a: list[tuple[int, str, str]], b: list[tuple[int, str, str]]) -> np.ndarray:
    """Scores of pairs of fingerprints."""
    best = np.zeros(len(a), np.int64)
    at, xs, ys = [], [], []
    for i, ((ba, sa, ta), (bb, sb, tb)) in enumerate(zip(a, b, strict=True)):
        for x, y in ([(sa, sb), (ta, tb)] if ba == bb else [(ta, sb)] if bb == 2 * ba else [(sa, tb)] if ba == 2 * bb else []):
            p, q = shorten(np.frombuffer(x.encode(), np.uint8)).tobytes(), shorten(np.frombuffer(y.encode(), np.uint8)).tobytes()
            if any(p[k : k + RUN] in q for k in range(len(p) - RUN + 1)):
                at.append(i)
                xs.append(p)
                ys.append(q)
    d = edit_distances(xs, ys)
    s = np.array([100 - (100 * int(k)) // (len(x) + len(y)) for k, x, y in zip(d, xs, ys, strict=True)], np.int64)
    np.maximum.at(best, np.array(at, np.int64), s)
    return best


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, block, sig, sig2) of every document."""
    ship_package(docs.sparkSession)
    return docs_of(docs).mapInArrow(_prints, "doc_id long, block long, sig string, sig2 string")


def matches(docs: DataFrame, least: int = MATCH, block: int = BLOCK) -> DataFrame:
    """(doc_id, class_id, fingerprint, n_links, match_id, score, links) of every document.

    class_id is the representative of the documents with the same fingerprint. A document that isn't the representative
    itself has one link, to it, with the score 100. A representative has one to every representative it matches: n_links is their number,
    match_id and score the best (ties: the lesser doc_id), and links lists those to lesser doc_ids, so that each link is in one
    list; what links two representatives links all members of their classes.
    """
    spark = docs.sparkSession
    fp = ["block", "sig", "sig2"]
    once = cut(fingerprints(docs).groupBy("doc_id").agg(F.min(F.struct(*fp)).alias("p")).select("doc_id", "p.*"), "prints")
    own = F.when(F.length("sig") == 0, F.col("doc_id").cast("string")).otherwise("")
    digest = F.unhex(F.md5(F.concat_ws(":", F.col("block").cast("string"), "sig", "sig2", own))).alias("digest")
    classes = once.select(digest, "doc_id").groupBy("digest").agg(F.min("doc_id").alias("rep"))
    p = cut(once.select("doc_id", *fp, digest).join(classes, "digest").select("doc_id", "rep", *fp), "classes")
    drop_cut(once)
    reps = p.where("doc_id = rep").select("doc_id", *fp)
    w = Window.partitionBy("key").orderBy("doc")
    every = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    runs = reps.mapInArrow(_keys, "key long, doc long").select("key", "doc", F.row_number().over(w).alias("r"), F.count("*").over(every).alias("n"))
    runs = cut(runs.where("n > 1"), "runs")
    # as many tasks as there are pairs to look at, whatever the bytes of their rows
    work = runs.where("r = 1").agg(F.sum(F.col("n") * F.col("n"))).first()[0] or 0
    tasks = int(min(100_000, max(spark.sparkContext.defaultParallelism, work // 4_000_000)))
    deal = runs.withColumn("c", F.floor((F.col("r") - 1) / block).cast("int")).withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    rows = deal.withColumnRenamed("doc", "doc_id").join(reps, "doc_id").withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("key", F.least("c", "o").alias("i"), F.greatest("c", "o").alias("j"), (F.col("c") > F.col("o")).cast("int").alias("side"), "doc_id", *fp)
    rows = rows.repartition(tasks, "key", "i", "j").sortWithinPartitions("key", "i", "j", "side", "doc_id")
    links = rows.mapInArrow(_pairs(least), _BY_DOCUMENT).groupBy("doc_id").agg(F.sum("n").alias("n"), F.max("best").alias("best"), F.array_sort(F.flatten(F.collect_list("links"))).alias("links"))
    twin = F.col("doc_id") != F.col("rep")
    pick = lambda t, c: F.when(twin, t).otherwise(c)
    return p.join(links, "doc_id", "left").select(
        "doc_id", F.col("rep").alias("class_id"), F.concat_ws(":", F.col("block").cast("string"), "sig", "sig2").alias("fingerprint"), pick(F.lit(1), F.coalesce("n", F.lit(0))).alias("n_links"),
        pick(F.col("rep"), -F.col("best.minus")).alias("match_id"), pick(F.lit(100), F.col("best.score")).alias("score"), "links",
    )


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches(spark.read.parquet(f"{sf_dir}/documents.parquet"))
