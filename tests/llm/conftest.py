import pytest

LONG = "Lorem ipsum dolor. " * 4000 + "x" * 50_000


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty, blank and long texts, repeated rows, other columns with names of results."""
    rows = [
        (1, None, None), (2, "", "en"), (3, "  \n\t ", "en"), (4, "one", None), (None, "no id here at all", "en"), (None, None, None),
        (5, LONG, "en"), (6, "Same text again and again with words enough.", "de"), (6, "Same text again and again with words enough.", "de"), (7, "Same text again and again with words enough.", "fr"),
        (8, "ÉÈ ß ﬁ İ 漢字 😀 don't", "fr"),
    ]
    data = [(i, t, lang, "x", 0.5, 7, "y", "z", True) for i, t, lang in rows]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, host string, score double, n_tokens int, verdict string, items string, kept boolean")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
