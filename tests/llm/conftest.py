import pytest


@pytest.fixture(scope="session")
def rows(spark):
    """rows(data, schema): a DataFrame."""
    return lambda data, schema: spark.createDataFrame(data, schema)


#: texts for the small tests: nulls, empty ones, one long one, repeated rows, and columns with clashing names
LONG = " ".join(f"w{i % 977}" for i in range(30_000))


@pytest.fixture(scope="session")
def odd_documents(spark):
    data = [(1, None, "en"), (2, "", "en"), (3, "  \t\n ", None), (4, "One two three four", "en"), (4, "One two three four", "en"),
            (5, "one TWO three four", "de"), (None, "no id here", "en"), (None, None, None), (6, LONG, "en"), (7, LONG + " end", "en"),
            (8, "12345 ---", "en"), (9, "äöü ÄÖÜ ß \x1c  x", "de")]
    clash = [(i, t, lang, f"s{(i or 0) % 2}" if i != 3 else None, 0, "x", 1, 2, 3)
             for i, t, lang in data]
    return spark.createDataFrame(clash, "doc_id long, text string, lang string, source string, n_chars long, fingerprint string, "
                                        "slot int, row long, kept int")


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)
