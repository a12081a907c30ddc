import base64
import heapq

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.llm import bpe as B
from quarry.llm import huffman as H

PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@pytest.fixture(scope="module")
def own():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open("/opt/tokenizers/byte_bpe_50k.tiktoken", "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def vocabulary():
    return B.Vocabulary()


def ids_of(v, texts, coder=None):
    raw = [t.encode() for t in texts]
    o = np.concatenate(([0], np.cumsum([len(r) for r in raw]))).astype(np.int64)
    ((ids, count),) = (coder or B.Encoder(v)).part([(np.frombuffer(b"".join(raw), np.uint8), o)])
    at = np.concatenate(([0], np.cumsum(count)))
    return [ids[i:j].tolist() for i, j in zip(at[:-1], at[1:], strict=True)]


ODD = ["", "  a  b\n\n c", "don't we'll  they've'x 'so ''s", "½²３ 中文 🙂🙂 — “x”", "a b c \t\n", "a" * 23, "\n\n\n", "   ", "<|endoftext|> x's's 're", "'", "it'", "x'll'd", "abab" * 20, "é́ \u0085z"]


def test_ids_are_those_of_the_library(own, vocabulary, docs):
    texts = ODD + [r.text for r in docs.select("text").collect()]
    assert ids_of(vocabulary, texts) == [own.encode_ordinary(t) for t in texts]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="ab 'stlre\n\t1é中. ", max_size=25), max_size=5))
def test_any_text_is_encoded_like_the_library(own, vocabulary, texts):
    assert ids_of(vocabulary, texts) == [own.encode_ordinary(t) for t in texts]


def test_forgetting_changes_nothing(own, vocabulary, monkeypatch, docs):
    monkeypatch.setattr(B, "REMEMBER", 50)
    coder = B.Encoder(vocabulary)
    for t in [r.text for r in docs.select("text").limit(20).collect()]:
        assert ids_of(vocabulary, [t], coder) == [own.encode_ordinary(t)]


def test_encode_and_decode_rows(odd, empty, own):
    rows = B.encode(odd)
    got = sorted(((r.doc_id or 0, r.token_ids, r.n_tokens, r.round_trip) for r in rows.collect()), key=str)
    want = sorted(((r.doc_id or 0, own.encode_ordinary(r.text or ""), len(own.encode_ordinary(r.text or "")), True) for r in odd.collect()), key=str)
    assert got == want
    back = sorted((r.doc_id or 0, r.text) for r in B.decode(rows).collect())
    assert back == sorted((r.doc_id or 0, r.text or "") for r in odd.collect())
    assert B.encode(empty).count() == 0


def huffman_bits(counts):
    h = [int(c) for c in counts if c]
    heapq.heapify(h)
    total = 0
    while len(h) > 1:
        s = heapq.heappop(h) + heapq.heappop(h)
        total += s
        heapq.heappush(h, s)
    return total


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2000), min_size=2, max_size=60))
def test_lengths_are_optimal_and_within_the_limit(counts):
    c = np.array(counts)
    n = int((c > 0).sum())
    size = H.code_lengths(c, 18)
    assert ((size > 0) == (c > 0)).all()
    if n > 1:
        assert (c * size).sum() == huffman_bits(c) and abs(sum(2.0**-k for k in size if k) - 1) < 1e-9
        short = H.code_lengths(c, 6)
        assert short.max() <= 6 and sum(2.0**-k for k in short if k) <= 1


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 40), max_size=40), max_size=8), st.integers(1, 9))
def test_blocks_decode_alone(rows, block):
    ids = np.array([i for r in rows for i in r], np.int64)
    ptr = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int64)
    book = H.Codebook(H.code_lengths(np.bincount(ids, minlength=50)))
    raw, start, cp, at = book.encode(ids, ptr, block)
    for k, r in enumerate(rows):
        bits, points = raw[start[k] : start[k + 1]].tobytes(), cp[at[k] : at[k + 1]].tolist()
        assert H.decode_row(book, len(r), bits, points, block) == r
        for j, p in enumerate(points):
            part = r[j * block : (j + 1) * block]
            assert book.decode(np.frombuffer(bits, np.uint8), np.array([p]), np.array([len(part)])).tolist() == part


def test_query_round_trip(spark, docs, odd, empty, own):
    for df in (docs, odd):
        rows, book = H.encode(df)
        got = sorted(((r.doc_id, H.decode_row(book, r.n_tokens, bytes(r.bits), r.checkpoints), r.round_trip) for r in rows.collect()), key=str)
        assert got == sorted(((r.doc_id, own.encode_ordinary(r.text or ""), True) for r in df.collect() if r.doc_id is not None), key=str)
    rows, book = H.encode(empty)
    assert rows.count() == 0 and not book.lengths.any()
