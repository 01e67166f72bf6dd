import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, node string, size int"


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Null ids and texts, empty and blank texts, a very long one, ties, repeated rows, clashing extra columns."""
    from approxspark.session import ensure_checkpoint_dir, ship_package

    ensure_checkpoint_dir(spark)
    ship_package(spark)
    long_text = " ".join(f"word{i % 977} of the long text number{i}" for i in range(6000))
    rows = [
        (1, "the quick brown fox jumps over the lazy dog again", "en", "a"), (2, "The  Quick brown\nfox jumps over the lazy dog again", "en", "a"),
        (3, None, "en", "a"), (4, "", "en", None), (5, " \t\n ", None, "b"), (6, long_text, "en", "b"), (7, long_text + " end", "en", "b"),
        (8, "der schnelle braune fuchs springt ueber den faulen hund", "de", "b"), (9, "two words", None, None), (10, "12345 !!", "de", "c"),
        (11, "the quick brown fox jumps over the lazy dog again", "en", "c"), (11, "the quick brown fox jumps over the lazy dog again", "en", "c"),
        (13, "the  quick brown fox jumps over the lazy dog again", "en", "c"), (None, "two words", "en", "a"), (None, None, None, None), (12, "<|endoftext|> a b \x1c c\t\td", "en", "a"),
    ]
    return spark.createDataFrame([(*r, 0, "x", 1) for r in rows], DOCS)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
