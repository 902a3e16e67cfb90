import pytest

#: Rows that every operator over documents must survive: nulls, empty and blank texts, ties, repeated rows, a very long text.
LONG = " ".join(f"word{i * 7919 % 1000003}" for i in range(60_000))
EDGE_DOCS = [
    (1, "the quick brown fox jumps over the lazy dog and runs away", "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, None),
    (4, " \n\t ", "en", "b"),
    (5, "1234 !!! ---", "en", "b"),
    (6, "the quick brown fox jumps over the lazy dog and runs away", "en", "a"),
    (6, "the quick brown fox jumps over the lazy dog and runs away", "en", "a"),
    (None, "le renard brun saute par dessus le chien paresseux", "fr", None),
    (8, LONG, "en", "c"),
    (9, "A", "en", "c"),
    (10, "naïve café 😀 größe " * 30, "de", "c"),
]
DOC_SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="session")
def edge_docs(spark):
    return spark.createDataFrame(EDGE_DOCS, DOC_SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
