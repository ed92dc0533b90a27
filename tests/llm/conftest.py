"""Small tables for the corpus operators."""

import pytest

#: Extra columns named like those that the operators use within.
EXTRA = "rid long, fp long, row string, id string, key string, h long, name string, level int, size long, position double, nth int, text_sha256 string, component long"
LONG = "The quick brown fox jumps over the lazy dog number nine. " * 4000


def documents(rows):
    """Rows of (doc_id, text, lang, source) with the extra columns filled with something in the way."""
    return [(*r, None if r[1] is None else len(r[1]), 1, 2, "r", "i", "k", 3, "n", 4, 5, 0.5, 6, "s", 7) for r in rows]


SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows and ids."""
    rows = [
        (1, "Hello World one two three four", "en", "a"),
        (2, "hello world ONE two three four", "en", "a"),
        (2, "hello world ONE two three four", "en", "a"),
        (3, None, "en", "b"),
        (4, "", None, None),
        (None, "", "en", "a"),
        (None, None, None, None),
        (5, LONG, "en", "a"),
        (6, LONG, "en", "c"),
        (7, LONG[:-1] + "x", "en", "c"),
        (8, "Été ß ñ 日本", "fr", "b"),
        (9, "été ß ñ 日本", "fr", "b"),
        (10, " \t\n ", "xx", "b"),
        (5, "another text of the same id", "en", "a"),
    ]
    return spark.createDataFrame(documents(rows), SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def corpus(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def texts(corpus):
    return {r.doc_id: r.text for r in corpus.select("doc_id", "text").collect()}
