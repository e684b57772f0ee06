import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, Predicted int, fp string, node string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows and
    columns whose names the operators use themselves."""
    long_text = "lorem ipsum dolor sit amet consectetur " * 4000
    rows = [
        (1, "a b c d e f", "en", "s", 11, 0.5, 1, "x", "y"),
        (1, "a b c d e f", "en", "s", 11, 0.5, 1, "x", "y"),
        (2, None, None, None, None, None, None, None, None),
        (3, "", "", "", 0, 0.0, 0, "", ""),
        (4, long_text, "en", "s", len(long_text), 1.0, 0, "z", "z"),
        (5, " \t\n ", "en", "s", 4, 1.0, 0, "z", "z"),
        (None, "no id here", "en", "s", 10, 1.0, 0, "z", "z"),
        (6, "é" * 50_000, "fr", "s", 50_000, 1.0, 0, "z", "z"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
