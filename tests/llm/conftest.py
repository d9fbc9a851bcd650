import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """Rows with nulls, empty and long texts, ties, repeats and clashing column names."""
    long = " ".join(f"word{i % 977} Über{i % 31}" for i in range(30_000))
    rows = [
        (1, "the quick brown fox jumps over the lazy dog and runs away\nfooter", "en", "a", 5),
        (2, "The quick brown fox jumps over the lazy dog and runs away\nfooter", "en", "a", 5),
        (2, "The quick brown fox jumps over the lazy dog and runs away\nfooter", "en", "a", 5),
        (3, None, None, None, None),
        (4, "", "en", "", 0),
        (5, "   \t\n ", "de", "b", 6),
        (6, long, "de", "b", 9),
        (7, "ein kurzer Satz\x00mit Ende\x00", "de", None, 3),
        (8, "don't stop 's \x01 <|endoftext|> ΑΣ e\u0301 \u2003x", None, "b", 1),
        (None, "no id here at all", "en", "a", 2),
    ]
    return spark.createDataFrame(
        [(*r, "x", "y", "z") for r in rows], DOCS + ", words string, bucket_ string, host string"
    )


@pytest.fixture(scope="session")
def empty(docs):
    return docs.where("false")
