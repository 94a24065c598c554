import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from conftest_helpers import prose  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, size string, _leaks0 int"


@pytest.fixture(scope="session")
def table(spark):
    """Documents from (doc_id, text, lang, source), with further columns named like those of the operators."""
    def make(rows):
        full = [(d, t, lang, source, len(t or ""), "own", "own", 7) for d, t, lang, source in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def awkward(table):
    """NULLs in every column, empty, blank and very long texts, ties and repeated rows."""
    long = prose(1, 60_000)
    return table([
        (None, None, None, None), (1, "", "en", "a"), (2, " \t\n", "en", None), (3, long, "en", "a"), (3, long, "en", "a"),
        (4, "one two", None, "b"), (5, "ONE two", "en", "b"), (None, "no id at all here", "en", "b"), (6, "!!! 123 ###", "en", ""),
        (7, prose(2, 50), "en", "a"), (8, prose(2, 50) + " extra", "en", "a"), (9, "日本語 текст Ελληνικά", "xx", "c"), (10, None, "en", "c"),
        (7, prose(3, 50), "en", "a"),
    ])


@pytest.fixture(scope="session")
def empty(table):
    return table([(0, "x", "en", "a")]).where("doc_id < 0")
