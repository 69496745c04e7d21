import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from gridlake.llm import words as W

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab \n\té日X", max_size=60)), max_size=6)


def lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s)


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.booleans(), st.sampled_from([3, 12]))
def test_words_and_runs_match_python(texts, low, k):
    block, W.BLOCK_BYTES = W.BLOCK_BYTES, 16
    try:
        w = W.words(pa.array(texts, pa.string()), lower=low)
    finally:
        W.BLOCK_BYTES = block
    want = [WORD.findall(lower(t or "") if low else (t or "")) for t in texts]
    assert [len(x) for x in want] == w.counts.tolist()
    seen = {}
    for i, row in enumerate(want):
        for word, h in zip(row, w.of(i)):
            assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)
    h, valid = W.runs(w, k)
    places = [(i, j) for i, row in enumerate(want) for j in range(len(row))]
    runs = {}
    for (i, j), hh, ok in zip(places, h, valid):
        assert ok == (j + k <= len(want[i]))
        if ok:
            assert runs.setdefault(tuple(want[i][j:j + k]), hh) == hh
    assert len(set(runs.values())) == len(runs)


def test_slices_cover_every_row():
    col = pa.array(["a" * 10, None, "b" * 100, "", "c"], pa.string())
    parts = list(W.text_slices(col, max_bytes=12))
    assert [a for a, _ in parts] == list(np.cumsum([0] + [m for _, m in parts])[:-1])
    assert sum(m for _, m in parts) == 5


def test_shingle_sets_of_short_texts():
    w = W.words(pa.array(["", "a", "a b", "a b c", "a b c a b c"], pa.string()))
    sets = W.shingle_sets(w, 3)
    assert [len(s) for s in sets] == [0, 1, 1, 1, 3]
    assert sets[1][0] != sets[2][0]
