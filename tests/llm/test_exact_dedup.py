"""Exact dedup against its definition, with hashes that collide."""

import hashlib
import re

from pyspark.sql import functions as F

from gridlake.llm.exact_dedup import drop_copies, exact_groups

SPACE = re.compile(r"[\x20\x09-\x0D]")


def brute(rows):
    """rows: (id, text)."""
    groups = {}
    for i, t in rows:
        groups.setdefault(SPACE.sub("", t or ""), []).append((-len(t or ""), i is None, i))
    out = []
    for i, t in rows:
        plain = SPACE.sub("", t or "")
        first = min(groups[plain], key=lambda r: (r[0], r[1], r[2] if r[2] is not None else 0))
        out.append((i, first[2], len(groups[plain]), first[2] == i and -first[0] == len(t or ""),
                    hashlib.sha256(plain.encode()).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted([(r["id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in df.collect()], key=str)


def few_hashes(plain):
    """A hash of two values: nearly everything collides."""
    return F.struct(F.pmod(F.char_length(plain), F.lit(2)).cast("long").alias("h1"), F.lit(7).cast("long").alias("h2"))


ODD = [(20, "o n e\u000b", "z"), (21, " one", "z"), (22, "ONE", "z"), (None, "one  ", "z"), (24, "\x1cone", "z"),
       (25, "nullidhere", "b"), (26, "   ", "b"), (27, "a\U0001F600b c", "u"), (28, "a \U0001F600 bc ", "u")]


def test_odd_rows_and_collisions(make_docs, odd_rows):
    rows = odd_rows + ODD + [(100 + i, f"text {i % 7}", "h") for i in range(200)]
    docs, plain = make_docs(rows), [(i, t) for i, t, _ in rows]
    want = brute(plain)
    assert result(exact_groups(docs)) == want
    assert result(exact_groups(docs, hash_of=few_hashes)) == want
    assert exact_groups(make_docs([])).count() == 0


def test_drop_copies_keeps_one_whole_row_of_each_group(make_docs, odd_rows):
    rows = odd_rows + ODD
    docs = make_docs(rows)
    for options in ({}, {"hash_of": few_hashes}):
        kept = drop_copies(docs, **options)
        assert kept.columns == docs.columns
        got = kept.collect()
        plain = [SPACE.sub("", r["text"] or "") for r in got]
        assert len(set(plain)) == len(plain) == len({SPACE.sub("", t or "") for _, t, _ in rows})
        best = {(i, t) for (i, t, _), (_, _, _, k, _) in zip(rows, [next(b for b in brute([(i, t) for i, t, _ in rows])
                                                                         if b[0] == i and b[4] == hashlib.sha256(
            SPACE.sub("", t or "").encode()).hexdigest()) for i, t, _ in rows]) if k}
        assert {(r["doc_id"], r["text"]) for r in got} <= best
    assert drop_copies(make_docs([])).count() == 0
