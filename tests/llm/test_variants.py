"""Spelling variants against brute force over shared deletions."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from gridlake.llm.queries import QUERIES, table
from gridlake.llm.variants import PositionIndex, count_words, letters_of, near_words, one_edit, variant_groups
from tests.conftest import SF_ORACLE

LETTERS = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_counts(rows, drop=97, least=3):
    counts = Counter()
    for i, t in rows:
        for run in LETTERS.findall(t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if drop and h % drop == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 5:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= least}


def is_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(counts):
    """(word, form, root, n, n_near, form_n) by meeting at shared deletions."""
    meet = defaultdict(set)
    for w in counts:
        for cut in {w} | {w[:i] + w[i + 1:] for i in range(len(w))}:
            meet[cut].add(w)
    near = defaultdict(set)
    for group in meet.values():
        for a in group:
            near[a].update(b for b in group if is_near(a, b))
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        if best is not None and counts[best] >= 2 * counts[w]:
            form[w] = best
    out = []
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), counts.get(form.get(w))))
    return sorted(out)


def test_query_equals_brute_force(spark):
    rows = table(spark, SF_ORACLE, "documents").select("doc_id", "text").collect()
    want = brute(brute_counts(rows))
    got = sorted(tuple(r) for r in QUERIES["op11_spelling_variants"](spark, SF_ORACLE).collect())
    assert got == want and sum(r[1] is not None for r in want) > 20


def test_counts_on_odd_rows(make_docs, odd_rows):
    rows = odd_rows + [(30 + i, "Étude étude ETUDE naïveté na×ve cafés xĀy "
                        + "Lösung " * i + "q" * 40 + " İstanbul", "d") for i in range(40)]
    for drop in (0, 3):
        got = {r["word"]: r["n"] for r in count_words(make_docs(rows), drop_one_in=drop).collect()}
        assert got == brute_counts([(i, t) for i, t, _ in rows], drop)
    assert variant_groups(count_words(make_docs([]))).count() == 0


def test_hot_buckets_are_cut_into_pieces(spark):
    """All words share their first half: one bucket in many pieces."""
    rng = np.random.default_rng(5)
    words = {"same" + "".join(rng.choice(list("abc"), rng.integers(3, 6))) for _ in range(700)}
    words |= {"x" * 5000, "x" * 5001, "y" + "x" * 4999, "tests", "teste", "tésts", "tessts", "ttests"}
    counts = {w: int(rng.integers(1, 60)) for w in sorted(words)}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    want = brute(counts)
    for piece in (16, 4096):
        got = variant_groups(frame, piece=piece).select("word", "form", "root", "n", "n_near", "form_n").collect()
        assert sorted(tuple(r) for r in got) == want
    best = {r["word"]: (r["n_near"], r["best"]) for r in near_words(frame, 16).collect()}
    assert best["x" * 5000] == (2, max("x" * 5001, "y" + "x" * 4999, key=lambda w: counts[w]))


short = st.text(alphabet="abé", min_size=1, max_size=9)


@settings(max_examples=200, deadline=None)
@given(st.sets(short, min_size=1, max_size=90), st.integers(0, 8))
def test_position_index(words, at):
    """Recurrences over bitsets equal edit distance one, for queries inside and outside the block."""
    words = sorted(words)
    index = PositionIndex(letters_of(words))
    query = words[at % len(words)]
    found = one_edit(index, letters_of([query])[0][None, :])[0]
    got = {w for i, w in enumerate(words) if int(found[i >> 6]) >> (i & 63) & 1}
    assert got == {w for w in words if is_near(query, w)}
