import pytest

DOCS = "doc_id long, text string, lang string, source string, n_words int, kept string, copies int, rows int, b int"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and blank texts, ties, repeated rows, a long text, and columns with clashing names."""
    long = " ".join(f"w{i * 7919 % 1000}" for i in range(20_000))
    texts = [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "ONE two"), (6, long), (7, long + " x"), (8, "a b c d e f"),
             (9, "a b c d e f"), (9, "a b c d e f"), (10, "日本語 — é"), (11, "123 !!"), (None, "a b c d e f"), (12, "z")]
    rows = [(i, t, "en" if (i or 0) % 3 else None, None if i == 4 else f"s{(i or 0) % 2}", 5, "k", 7, 8, 9) for i, t in texts]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
