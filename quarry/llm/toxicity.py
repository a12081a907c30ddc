"""Toxicity by weak supervision: voters, a generative label model, and a linear classifier on its posterior labels.

Voters look at the folded words of the whole text, and at the words after look-alike signs are read as letters (1 as i, $
as s and so on): five lexicons (insults, contempt, profanity, threats, dehumanising words), insulting phrases, an insult
within three words of "you", two distinct lexicon words or more, lexicon words by length, and a disguised lexicon word. As no
list covers every language, one more lexicon is mined from
at most LABEL_DOCS labelled documents (the first in the order of a hash of their doc_id): the words, and the beginnings of words of
STEMS bytes, that a likelihood ratio of MINED or more ties to toxic ones that aren't copies of each other; one voter asks for one word that is
or begins so, one for two. Each voter votes 1 or
abstains; how often it abstains in either class tells as well, but only in languages (by the column lang) where it votes on one document in
1 / COVERED or more: elsewhere it isn't asked.

The counts of all vote patterns by language over all documents are what the label model is fitted to (a pattern is one of a bounded
number, so they fit on the driver): expectation-maximisation estimates how often each voter casts each vote given either
class, and the class share. What two voters share beyond the classes is measured as the correlation of their votes'
residuals, and each voter's log-odds are divided by one plus the sum of its correlations, so that voters that repeat
each other don't count double.

A logistic classifier is then fitted to the posteriors of at most TRAIN_DOCS documents of either likely class (first in
the order of a hash of their doc_id), on the votes and on the presence of the words that tell the classes apart best,
and it scores every document.

Defined results: a null or empty text has no votes; if no voter ever votes 1, all scores are 0;
rows without a doc_id are left out; rows that repeat a doc_id are scored one by one; an empty table gives no rows.
Other columns, whatever their names, are left as they are, and a text of any length is read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import docs_of, fold, mix, numbered, prefixes, steps, text_words, words
from quarry.llm.linear import fit, sigmoid
from quarry.session import cut, ship_package

TRAIN_DOCS = 2000
LABEL_DOCS = 12_000
MINED = 10.0
#: Least share of toxic ones among the labelled documents that have such a word.
PURE = 0.97
#: Bytes of the beginnings of words that are mined; only of longer words.
STEMS = (5, 7)
WORDS = 256
#: Share of a language's documents that a voter must vote on for its abstaining to be evidence there.
COVERED = 0.001
TOXIC = 0.5

LEXICONS = {
    "insult": "idiot idiots idiotic moron morons moronic imbecile cretin dimwit dumbass dunce clown clowns loser losers fool fools jerk creep buffoon halfwit nitwit simpleton twit wanker blockhead dolt",
    "contempt": "stupid pathetic worthless disgusting useless dumb ugly repulsive despicable contemptible vile revolting disgrace disgraceful hideous filthy brainless spineless gutless retarded retard wretched",
    "profanity": "damn bastard bastards bitch bitches shit shitty bullshit crap fuck fucking fucked fucker motherfucker asshole assholes ass arse dick dickhead prick piss pissed whore slut cunt bollocks",
    "threat": "kill murder strangle rape hang stab shoot lynch behead exterminate slaughter",
    "dehumanise": "scum trash garbage vermin filth parasite parasites subhuman cockroach cockroaches maggot maggots pig pigs swine rat rats savages animals pest degenerate degenerates",
}
#: Words that are also harmless alone: one of them is no vote of its lexicon.
MILD = frozenset("kill murder rape hang stab shoot fool trash garbage pig pigs rat rats animals ass pest clown clowns creep damn crap useless ugly dumb filthy slaughter piss vile arse dick prick hang".split())
PHRASES = "shut up|go to hell|kill yourself|drop dead|you suck|i hate you|you make me sick|nobody likes you|piece of shit|piece of trash|piece of garbage|waste of space|go die|hope you die|you people|screw you|get lost|you disgust me|worthless piece".split("|")
VOTERS = [*LEXICONS, "phrase", "aimed", "several", "density", "disguised", "mined", "mined_twice"]
_LOOK = np.arange(256, dtype=np.uint8)
for _a, _b in zip(b"013457@$!", b"oieastasi", strict=True):
    _LOOK[_a] = _b


def _hashes(text: str) -> np.ndarray:
    return np.sort(text_words(text))


def _stems(b: np.ndarray, w: tuple) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers and hashes of the beginnings of words, a size at a time."""
    return prefixes(fold(b), w[1], w[2], STEMS)


class Voters:
    """The voters' word lists as sorted hashes."""

    def __init__(self, mined: np.ndarray) -> None:
        self.mined = mined
        self.lists = [_hashes(x) for x in LEXICONS.values()]
        self.all = np.unique(np.concatenate(self.lists))
        self.mild = _hashes(" ".join(sorted(MILD)))
        self.you = _hashes("you your youre u ur yourself")
        self.phrases = [text_words(p) for p in PHRASES]
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(mined >> np.uint64(48)).astype(np.int64)] = True
        self.known = np.unique(np.concatenate([self.all, *self.phrases]))

    def votes(self, b: np.ndarray, o: np.ndarray, w: tuple | None = None) -> np.ndarray:
        """Texts by voters, of 1, 0 and -1."""
        whole = words(b, o) if w is None else w
        h, _, _, ptr = whole
        n = len(o) - 1
        out = np.zeros((n, len(VOTERS)), np.int8)
        maybe = np.zeros(1 << 16, bool)
        maybe[(self.known >> np.uint64(48)).astype(np.int64)] = True
        at = np.flatnonzero(maybe[(h >> np.uint64(48)).astype(np.int64)])
        at = at[np.isin(h[at], self.known)]
        x = h[at]
        doc_of = np.searchsorted(ptr, at, "right") - 1
        bad = np.isin(x, self.all)
        mild = np.isin(x, self.mild)

        def distinct(use: np.ndarray) -> np.ndarray:
            """Distinct words of each text among these hits."""
            if not use.any():
                return np.zeros(n, np.int64)
            pairs = np.unique(np.stack((doc_of[use].astype(np.uint64), x[use])), axis=1)
            return np.bincount(pairs[0].astype(np.int64), minlength=n)

        for k, words_ in enumerate(self.lists):
            use = np.isin(x, words_)
            out[:, k] = (distinct(use & ~mild) > 0) | (distinct(use) > 1)
        k = len(self.lists)
        for p in self.phrases:
            i = at[(x == p[0]) & (ptr[doc_of + 1] - at >= len(p))]
            for j in range(1, len(p)):
                i = i[h[i + j] == p[j]]
            out[np.searchsorted(ptr, i, "right") - 1, k] = 1
        hits, owner = at[bad], doc_of[bad]
        for step in (-3, -2, -1, 1, 2, 3):
            j = hits + step
            ok = (j >= ptr[owner]) & (j < ptr[owner + 1])
            ok[ok] = np.isin(h[j[ok]], self.you)
            out[owner[ok], k + 1] = 1
        kinds = distinct(bad)
        count = np.bincount(owner, minlength=n)
        size = np.maximum(np.diff(ptr), 1)
        out[:, k + 2] = kinds >= 2
        out[:, k + 3] = (count >= 2) & (count * 100 >= size)
        looks = _LOOK[b]
        signs = np.flatnonzero(looks != b)
        if len(signs):
            some = np.unique(np.searchsorted(o, signs, "right") - 1)
            for i in some:
                part = looks[o[i] : o[i + 1]]
                g = words(part, np.array([0, len(part)]))[0]
                plain = h[ptr[i] : ptr[i + 1]]
                new = g[maybe[(g >> np.uint64(48)).astype(np.int64)]]
                new = new[np.isin(new, self.all) & ~np.isin(new, self.mild) & ~np.isin(new, plain)]
                out[i, k + 4] = len(new) > 0
        if len(self.mined):
            of = np.repeat(np.arange(n), np.diff(ptr))
            at = [np.flatnonzero(self._is_mined(h))]
            for which, g in _stems(b, whole):
                at.append(which[self._is_mined(g)])
            at = np.unique(np.concatenate(at))
            pairs = np.unique(np.stack((of[at].astype(np.uint64), h[at])), axis=1)
            found = np.bincount(pairs[0].astype(np.int64), minlength=n)
            out[:, k + 5], out[:, k + 6] = found >= 1, found >= 2
        return out

    def _is_mined(self, g: np.ndarray) -> np.ndarray:
        out = self.maybe[(g >> np.uint64(48)).astype(np.int64)]
        at = np.flatnonzero(out)
        out[at] = np.isin(g[at], self.mined)
        return out


def pack(votes: np.ndarray) -> np.ndarray:
    """One number for each row of votes."""
    return ((votes.astype(np.int64) + 1) * 3 ** np.arange(votes.shape[1])).sum(1)


def unpack(codes: np.ndarray, n: int = len(VOTERS)) -> np.ndarray:
    return (codes[:, None] // 3 ** np.arange(n)) % 3 - 1


class LabelModel:
    """Class share, vote shares of each voter by class, correlations, and with them the posterior of a pattern of votes."""

    def __init__(self, patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> None:
        votes = patterns.astype(int)
        n, m = votes.shape
        counts = counts.astype(float)
        self.none = not (votes == 1).any()
        # the start: a document for which more than one voter, or any that sees a phrase, votes
        q = np.clip(0.02 + 0.49 * np.minimum((votes == 1).sum(1), 2), 0, 0.98)
        self.share = 0.1
        self.table = np.zeros((2, m, 3))
        for _ in range(rounds):
            for y, r in ((0, (1 - q) * counts), (1, q * counts)):
                for v in (0, 1):
                    self.table[y, :, v + 1] = ((votes == v) * r[:, None]).sum(0) + 0.5
                self.table[y, :, 1:] /= self.table[y, :, 1:].sum(1, keepdims=True)
            self.table[:, :, 0] = 1.0  # not asked: no evidence
            self.share = float(np.clip((q * counts).sum() / counts.sum(), 1e-4, 0.5))
            # a voter never speaks for the class it votes against
            odds = np.log(self.table[1] / self.table[0])
            odds[:, 2], odds[:, 1] = np.maximum(odds[:, 2], 0), np.minimum(odds[:, 1], 0)
            self.odds = odds
            self.damp = np.ones(m)
            q = self.posterior(votes)
        # residual correlations of votes, given the class
        mean = self.table[:, :, 2]
        cov = np.zeros((m, m))
        for y, r in ((0, (1 - q) * counts), (1, q * counts)):
            e = np.where(votes < 0, 0, votes - mean[y])
            cov += (e * r[:, None]).T @ e
        sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
        self.correlation = np.clip(cov / np.outer(sd, sd), -1, 1)
        np.fill_diagonal(self.correlation, 0)
        self.damp = 1 + np.maximum(self.correlation, 0).sum(1)
        hit = self.share * self.table[1, :, 2]
        self.accuracy = hit / (hit + (1 - self.share) * self.table[0, :, 2])

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability that a document with these votes is toxic."""
        if self.none:
            return np.zeros(len(votes))
        v = votes.astype(int) + 1
        z = np.log(self.share / (1 - self.share)) + (self.odds[np.arange(votes.shape[1]), v] / self.damp).sum(1)
        return sigmoid(z)


def _patterns(mined: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters = Voters(mined)
        for batch, b, o in steps(batches):
            yield pa.record_batch({"doc_id": batch.column(0), "lang": batch.column(2), "code": pack(voters.votes(b, o))})

    return run


def _sampled(mined: np.ndarray, stems: bool = False):
    """Distinct words of each text (and the beginnings of words), and its votes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters = Voters(mined)
        for batch, b, o in steps(batches):
            w = words(b, o)
            ptr, h = w[3], w[0]
            if stems:
                parts = [(np.arange(len(h)), h), *_stems(b, w)]
                which, h = (np.concatenate(x) for x in zip(*parts, strict=True))
                order = np.argsort(which, kind="stable")
                h, ptr = h[order], np.searchsorted(which[order], ptr)
            rows = [np.unique(h[i:j]).tobytes() for i, j in zip(ptr[:-1], ptr[1:], strict=True)]
            yield pa.record_batch({"doc_id": batch.column(0), "lang": batch.column(2), "code": pack(voters.votes(b, o, w)), "words": pa.array(rows, pa.binary())})

    return run


def mine(docs: DataFrame, labels: DataFrame, label_docs: int = LABEL_DOCS) -> np.ndarray:
    """Sorted hashes of the words that are tied to labelled toxic documents; of a doc_id's labels the greatest counts."""
    none = np.zeros(0, np.uint64)
    d = docs_of(docs, "lang")
    t, at = numbered(labels)
    lab = t.select(F.col(at["doc_id"]).try_cast("long").alias("doc_id"), F.col(at["toxic"]).cast("int").alias("y")).where("doc_id is not null and y is not null").groupBy("doc_id").agg(F.max("y").alias("y"))
    ids = lab.join(d.select("doc_id"), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(label_docs)
    truth = {r["doc_id"]: r["y"] > 0 for r in ids.collect()}
    if len(set(truth.values())) < 2:
        return none
    rows = d.join(F.broadcast(docs.sparkSession.createDataFrame([(k,) for k in truth], "doc_id long")), "doc_id", "left_semi").mapInArrow(_sampled(none, stems=True), "doc_id long, lang string, code long, words binary").collect()
    rows = list({r["words"]: r for r in sorted(rows, key=lambda r: -r["doc_id"])}.values())  # copies count once
    sets = [np.frombuffer(r["words"], np.uint64) for r in rows]
    y = np.array([truth[r["doc_id"]] for r in rows], float)
    share = y.mean()
    if not 0 < share < 1:
        return none
    u, back = np.unique(np.concatenate(sets), return_inverse=True)
    a = np.bincount(back, np.repeat(y, [len(x) for x in sets]), len(u))
    n = np.bincount(back, minlength=len(u))
    with np.errstate(divide="ignore", invalid="ignore"):
        g = np.where(a > 0, a * np.log(a / n / share), 0) + np.where(a < n, (n - a) * np.log((1 - a / n) / (1 - share)), 0)
    # near copies of one document are one witness: documents that share a least hash, under the seed that leaves fewest
    least = np.stack([[mix(x + np.uint64(seed)).min() if len(x) else 0 for x in sets] for seed in range(1, 5)])
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    order = np.argsort(back, kind="stable")
    at = np.searchsorted(back[order], np.arange(len(u) + 1))
    out = []
    for k in np.flatnonzero((g >= MINED) & (a / n >= PURE)):
        who = owner[order[at[k] : at[k + 1]]]
        who = who[y[who] > 0]
        alone = min(len(np.unique(row[who])) for row in least)
        if -alone * np.log(share) >= MINED:
            out.append(u[k])
    return np.array(out, np.uint64)


class Classifier:
    """Logistic over votes and the presence of selected words."""

    def __init__(self, votes: np.ndarray, sets: list[np.ndarray], p: np.ndarray) -> None:
        flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        u, back = np.unique(flat, return_inverse=True)
        a, c = np.bincount(back, p[owner], len(u)), np.bincount(back, (1 - p)[owner], len(u))
        na, nc = p.sum(), (1 - p).sum()
        # signed root of the likelihood ratio: words that are far more frequent in one class
        gain = np.log((a + 1) / (na + 2)) - np.log((c + 1) / (nc + 2))
        strong = (a + c >= 5) & (np.abs(gain) > 1.5)
        score = np.where(strong, np.abs(gain) * np.sqrt(a + c), 0)
        top = np.argsort(-score, kind="stable")[:WORDS]
        self.words = np.sort(u[top[score[top] > 0]])
        x = np.zeros((len(sets), len(self.words)), np.float32)
        if len(self.words) and len(flat):
            i = np.minimum(np.searchsorted(self.words, flat), len(self.words) - 1)
            hit = self.words[i] == flat
            x[owner[hit], i[hit]] = 1
        w, c = fit(np.concatenate((votes, x), 1), p, l2=1e-3, rounds=400)
        self.votes_w, self.words_w, self.c = w[: votes.shape[1]], w[votes.shape[1] :], float(c)

    def scores(self, votes: np.ndarray, h: np.ndarray, ptr: np.ndarray) -> np.ndarray:
        z = votes @ self.votes_w + self.c
        if len(self.words):
            maybe = np.zeros(1 << 16, bool)
            maybe[(self.words >> np.uint64(48)).astype(np.int64)] = True
            at = np.flatnonzero(maybe[(h >> np.uint64(48)).astype(np.int64)])
            i = np.minimum(np.searchsorted(self.words, h[at]), len(self.words) - 1)
            hit = self.words[i] == h[at]
            at, i = at[hit], i[hit]
            doc = np.searchsorted(ptr, at, "right") - 1
            pairs = np.unique(doc * len(self.words) + i)
            z = z + np.bincount(pairs // len(self.words), self.words_w[pairs % len(self.words)], len(ptr) - 1)
        return sigmoid(z)


def _classify(model: Classifier | None, mined: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters = Voters(mined)
        for batch, b, o in steps(batches):
            if model is None:
                p = np.zeros(len(o) - 1)
            else:
                w = words(b, o)
                p = model.scores(voters.votes(b, o, w).astype(np.float32), w[0], w[3])
            yield pa.record_batch({"doc_id": batch.column(0), "p_toxic": np.asarray(p, np.float64), "toxic": pa.array(p >= TOXIC)})

    return run


class Asked:
    """Which voters are asked in which language, of the counts of vote patterns."""

    def __init__(self, rows: list) -> None:
        votes = unpack(np.array([r["code"] for r in rows]))
        count = np.array([r["count"] for r in rows], float)[:, None]
        self.covered = {}
        for name in {r["lang"] for r in rows}:
            at = np.array([r["lang"] == name for r in rows])
            self.covered[name] = ((votes[at] > 0) * count[at]).sum(0) >= COVERED * count[at].sum()

    def votes(self, langs: list, codes: np.ndarray) -> np.ndarray:
        """Votes of patterns: 1, 0 where a voter abstains, -1 where it isn't asked."""
        v = unpack(codes)
        asked = np.array([self.covered.get(x, np.zeros(v.shape[1], bool)) for x in langs]).reshape(v.shape)
        return np.where(v > 0, 1, np.where(asked, 0, -1))


def label_model(docs: DataFrame, mined: np.ndarray) -> tuple[LabelModel | None, Asked | None, DataFrame]:
    """The label model of all documents' votes, which voters were asked, and the vote pattern of each document, a written table."""
    ship_package(docs.sparkSession)
    t = docs_of(docs, "lang").mapInArrow(_patterns(mined), "doc_id long, lang string, code long")
    t = cut(t.withColumn("lang", F.coalesce("lang", F.lit(""))), "votes")
    counts = t.groupBy("lang", "code").count().orderBy("lang", "code").collect()
    if not counts:
        return None, None, t
    asked = Asked(counts)
    votes = asked.votes([r["lang"] for r in counts], np.array([r["code"] for r in counts]))
    return LabelModel(votes, np.array([r["count"] for r in counts])), asked, t


def score(docs: DataFrame, labels: DataFrame | None = None, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """(doc_id, p_toxic, toxic) of every document; without labels nothing is mined."""
    spark = docs.sparkSession
    ship_package(spark)
    mined = np.zeros(0, np.uint64) if labels is None else mine(docs, labels)
    model, asked, t = label_model(docs, mined)
    final = None
    if model is not None and not model.none:
        seen = t.select("lang", "code").distinct().collect()
        p = model.posterior(asked.votes([r["lang"] for r in seen], np.array([r["code"] for r in seen])))
        likely = spark.createDataFrame([(r["lang"], r["code"], bool(x >= 0.5)) for r, x in zip(seen, p, strict=True)], "lang string, code long, likely boolean")
        ids = None
        for side in (True, False):
            part = t.join(F.broadcast(likely.where(F.col("likely") == side)), ["lang", "code"]).select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_docs)
            ids = part if ids is None else ids.unionAll(part)
        ids = cut(ids, "sample")
        rows = docs_of(docs, "lang").join(F.broadcast(ids.distinct()), "doc_id", "left_semi").mapInArrow(_sampled(mined), "doc_id long, lang string, code long, words binary").collect()
        rows.sort(key=lambda r: (r["doc_id"], r["lang"] or "", r["code"], r["words"]))
        codes = np.array([r["code"] for r in rows])
        final = Classifier(unpack(codes).astype(np.float32), [np.frombuffer(r["words"], np.uint64) for r in rows], model.posterior(asked.votes([r["lang"] or "" for r in rows], codes)))
    return docs_of(docs).mapInArrow(_classify(final, mined), "doc_id long, p_toxic double, toxic boolean")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
