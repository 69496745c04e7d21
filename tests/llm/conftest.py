"""Small tables for the operator tests."""

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, key string"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text, source) rows, with extra columns whose
    names clash with names the operators use."""
    def make(rows):
        data = [(i, t, "en", s, None if t is None else len(t), 7, "k") for i, t, s in rows]
        return spark.createDataFrame(data, DOC_SCHEMA)
    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty texts, ties, repeats and one very long text."""
    return [(1, None, "a"), (2, "", None), (3, "one", "a"), (3, "one", "a"), (None, "null id here", "b"),
            (5, " \t\n ", "b"), (6, " ".join(f"w{i % 977}" for i in range(30000)), "c"), (7, "one", None),
            (8, "x" * 5000, "c"), (9, "the same five words again and again", "a"),
            (10, "the same five words again and again", "a"), (11, "word " * 3, "d")]
