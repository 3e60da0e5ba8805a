import pytest

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows."""
    long_text = " ".join(f"word{i % 977} and" for i in range(60_000))
    rows = [
        (1, None, "en", "s", 0), (2, "", "en", "s", 0), (3, "   \n\t ", None, None, None), (4, long_text, "en", "s", len(long_text)),
        (5, "same text of a few words here", "en", "s", 29), (6, "same text of a few words here", "en", "s", 29),
        (7, "repeated row", "de", "s", 12), (7, "repeated row", "de", "s", 12), (None, "no id but text enough", "en", "s", 21),
        (8, "12345 67890", "en", "s", 11), (9, "Éa ßü ñ", "fr", "s", 7),
    ]
    return spark.createDataFrame(rows, DOC)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
