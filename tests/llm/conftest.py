import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASH = DOCS + ", score double, n_words bigint, row string, fingerprint string, kept_text string, `mm_ta` int, `a b` int"


def doc(i, text, *more):
    return (i, text, "en", "src0", len(text) if text is not None else None, *more)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null ids and texts, empty and very long texts, repeated rows, and columns with clashing names."""
    long = "alpha beta gamma " * 60_000
    extra = (0.5, 1, "x", "f", "k", 3, 4)
    rows = [doc(1, None), doc(2, ""), doc(3, " \t\n"), doc(4, long), doc(5, "one two three"), doc(5, "one two three"), doc(None, "null id"), doc(7, "Ünïcode … 日本 \U0001f600 end"), doc(8, "\n\n  Line \nline\n")]
    return spark.createDataFrame([r + extra for r in rows] + [(9, "nulls", None, None, None, None, None, None, None, None, None, None)], CLASH)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
