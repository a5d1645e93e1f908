"""Fixtures for the operators on training data."""

from __future__ import annotations

import pytest

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a documents table from (doc_id, text) or (doc_id, text, source) rows."""

    def make(rows, schema=DOCUMENTS):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, schema)

    return make


#: null and empty texts, blanks, ties, repeated rows, a null id, a very long text
AWKWARD = [
    (1, None), (2, ""), (3, " \t\n "), (4, "one two three four five six seven eight"),
    (5, "one two three four five six seven eight"), (5, "one two three four five six seven eight"),
    (None, "a null id"), (6, "ONE two Three four five six seven eight"), (7, "é" * 3000 + " ü"),
    (8, "word " * 30_000), (9, "  odd   space"), (10, "line\nline\n\nline"),
]
