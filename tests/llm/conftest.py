import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, rid long, size long, score double, rows string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows and columns that clash with the operators' own names."""
    long_text = "lorem ipsum dolor " * 20_000
    rows = [
        (1, "the same words stand here again and again", "en", "a", 41, 7, 7, 0.5, "x"), (2, "the same words stand here again and again", "en", "a", 41, 7, 7, 0.5, "x"),
        (3, None, "en", "a", None, None, None, None, None), (4, "", "en", "b", 0, 1, 1, 0.1, "y"), (5, "...!!! 12 34", None, "b", 12, 1, 1, 0.1, "y"), (None, "an id is missing from this row of words", "en", None, 39, 1, 1, 0.1, "y"),
        (6, long_text, "en", "c", len(long_text), 1, 1, 0.1, "y"), (7, "ein ganz anderer Satz über Bäume", "de", "c", 32, 1, 1, 0.1, "y"), (7, "ein ganz anderer Satz über Bäume", "de", "c", 32, 1, 1, 0.1, "y"),
        (8, "word", "en", None, 4, 1, 1, 0.1, "y"), (9, "日本語 ñandú 𝒳", None, "d", 10, 1, 1, 0.1, "y"),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
