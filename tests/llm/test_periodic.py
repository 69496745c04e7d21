"""Periodic runs against brute force over all periods."""

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from gridlake.llm import words as W
from gridlake.llm.periodic import periodic_runs, runs_of_texts
from gridlake.llm.queries import QUERIES, table, with_repeated_tail
from tests.conftest import SF_ORACLE

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words, min_words=6):
    """Every period is tried at every place; a stretch counts at its smallest period."""
    _, w = np.unique(np.array([hash(x) for x in words], dtype=np.int64), return_inverse=True) if words else (0, np.zeros(0))
    n, found = len(w), {}
    for q in range(1, n // 4 + 1):
        same = np.concatenate([[0], (w[:-q] == w[q:]).astype(np.int8), [0]])
        edge = np.diff(same)
        for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
            length = b - a + q
            if length >= max(min_words, 4 * q) and (a, length) not in found:
                found[a, length] = q
    # a stretch inside one of a smaller period has that period too: same maximal stretch, found first
    return sorted((a, n, q) for (a, n), q in found.items())


def tail(ident, words):
    n, h = len(words), zlib.crc32(str(ident).encode())
    g = h // 10
    if h % 10 or not n or ident is None:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def brute(ident, words):
    runs = brute_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-(r[1] * 10 ** 12 // r[2]), r[0], r[2])) if runs else None
    return (ident, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(x for i, x in enumerate(words) if i not in gone).encode()).hexdigest())


def test_query_equals_brute_force(spark):
    rows = table(spark, SF_ORACLE, "documents").select("doc_id", "text").collect()
    want = sorted(brute(i, tail(i, WORD.findall(t or ""))) for i, t in rows)
    got = sorted(tuple(r) for r in QUERIES["op13_periodic_runs"](spark, SF_ORACLE).collect())
    assert got == want and sum(r[1] for r in want) > 60


def test_edge_rows(make_docs, odd_rows):
    rows = odd_rows + [(50, "a " * 6, "p"), (51, "a " * 5, "p"), (52, "a b " * 4, "p"), (53, "a b " * 3 + "a", "p"),
                       (54, "x " + "a b c d e " * 9 + "a b y", "p"), (55, "a a a b " * 6, "p"),
                       (56, ("a a a a a a b " * 4 + "c ") * 5, "p"), (57, " ".join(f"v{i % 1301}" for i in range(20000)), "p")]
    got = sorted([(r["id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed_text"])
                  for r in periodic_runs(make_docs(rows)).collect()], key=str)
    want = []
    for i, t, _ in rows:
        words = WORD.findall(t or "")
        runs = brute_runs(words)
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        want.append((i, len(words), runs, " ".join(x for k, x in enumerate(words) if k not in gone)))
    assert got == sorted(want, key=str)
    assert periodic_runs(make_docs([])).count() == 0


def test_rewritten_tail(make_docs, odd_rows):
    rows = odd_rows + [(i, " ".join(f"t{k}" for k in range(i % 60)), "x") for i in range(100, 400)]
    got = sorted([(r["doc_id"], WORD.findall(r["text"] or "")) for r in with_repeated_tail(make_docs(rows)).collect()], key=str)
    assert got == sorted([(i, tail(i, WORD.findall(t or ""))) for i, t, _ in rows], key=str)


pieces = st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=24), st.integers(1, 9)), min_size=1, max_size=5)


@settings(max_examples=300, deadline=None)
@given(st.lists(pieces, min_size=1, max_size=4))
def test_random_texts(texts):
    """Repeated pieces over three words: nested and neighbouring runs of all scales."""
    words = [[f"w{x}" for part, times in text for x in part * times] for text in texts]
    got = runs_of_texts(W.words(pa.array([" ".join(x) for x in words])), 6, 4)
    assert got == [brute_runs(x) for x in words]
