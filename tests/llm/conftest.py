import pytest


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls, empty texts, ties, repeated rows, a long text, and columns whose names clash with added ones."""
    long = " ".join(f"wörd{i % 977} token{i % 13}" for i in range(20_000))
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "s", 0),
        (3, "   \n", "en", "s", 4),
        (4, "the cat and the dog of that house", "en", "s", 33),
        (4, "the cat and the dog of that house", "en", "s", 33),
        (5, "der hund und die katze in dem haus", "de", "s", 34),
        (6, long, "de", None, len(long)),
        (7, long, None, "s", len(long)),
        (None, "12345 67890 !!", "en", "s", 14),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    extra = spark.range(1).selectExpr("1 AS one").crossJoin(df)
    return extra.selectExpr("*", "'mine' AS score", "7 AS n_tokens", "1.5 AS hits", "'k' AS kept", "'x' AS set", "'y' AS size", "'z' AS rid").drop("one")


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")
