import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, ids int, pattern string, `key` string, `_id` string"


@pytest.fixture(scope="session")
def docs(spark):
    """(make, odd): make turns texts or (id, text, source) rows into documents with clashing extra columns; odd holds the hard cases."""

    def make(rows):
        rows = [r if isinstance(r, tuple) else (i, r, "src0") for i, r in enumerate(rows)]
        return spark.createDataFrame([(i, t, "en", s, len(t) if t is not None else None, 7, "x", "y", "z") for i, t, s in rows], SCHEMA).repartition(3)

    odd = [
        (0, None, "a"), (1, "", "b"), (2, " \n\t", None), (3, "one", "a"), (4, "Same text, twice over. " * 9, "a"), (5, "Same text, twice over. " * 9, "b"),
        (5, "Same text, twice over. " * 9, "b"), (None, "Same text, twice over. " * 9, "c"), (None, None, None), (6, "word " * 30_000, "a"), (7, "ünïcödé 日本語 🙂 " * 20, "c"),
        (8, "All rights reserved. CC BY 4.0\nSPDX-License-Identifier: (MIT OR GPL-2.0-only WITH Classpath-exception-2.0) AND BSD-3-Clause", "d"), (9, "a\x00b\r\n\x85c", "e"),
    ]
    return make, odd
