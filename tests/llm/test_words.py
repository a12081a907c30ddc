import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.llm import common as C


def arrays(texts):
    return C.buffers(pa.array(texts, pa.string()))


def spelled(texts):
    b, o = arrays(texts)
    h, s, e, ptr = C.words(b, o)
    raw = b.tobytes()
    return [[raw[x:y].decode() for x, y in zip(s[i:j], e[i:j], strict=True)] for i, j in zip(ptr[:-1], ptr[1:], strict=True)], h


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab Zé.É—ñ\n9_", max_size=30), max_size=6))
def test_words_are_those_of_a_pattern(texts):
    got, _ = spelled(texts)
    assert got == [re.findall(r"[^\W_]+", t) for t in texts]


def test_equal_words_have_equal_hashes_wherever_they_stand():
    texts = ["Straße ÉTÉ", "x" * 5000 + " été straße", "ПРИВЕТ привет Ωμέγα", "", None, "ab"]
    b, o = arrays(texts)
    h, _, _, ptr = C.words(b, o)
    d = [h[i:j].tolist() for i, j in zip(ptr[:-1], ptr[1:], strict=True)]
    assert d[0] == d[1][1:][::-1] and d[2][0] == d[2][1] and d[3] == d[4] == []
    assert C.text_words("ab").tolist() == d[5]


def test_pieces_of_a_large_batch_give_the_same(monkeypatch):
    texts = ["été " * 50 + "w" * 300 + " ab, c " * 40, "", "zz"] * 3
    whole = spelled(texts)
    monkeypatch.setattr(C, "_PIECE", 64)
    parts = spelled(texts)
    assert whole[0] == parts[0] and np.array_equal(whole[1], parts[1])


def test_window_hashes_depend_on_the_words_alone():
    h = C.text_words("a b c d a b c x")
    w = C.window_hashes(h, 3)
    assert w[0] == w[4] and len(set(w.tolist())) == 5
