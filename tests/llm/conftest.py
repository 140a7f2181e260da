import pytest

# Columns of these names are in the caller's table and must not disturb the operators.
CLASH = "_id string, _text string, _c0 string, score string, size string, n_words string, _key string"


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Null ids and texts, empty and long texts, repeated rows, clashing extra columns."""
    long = " ".join(f"wörd{i % 5000} the" for i in range(60_000))
    rows = [
        (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, " \t\n ", "en", None, 3),
        (4, long, "en", "b", len(long)), (5, "one two three four five six", "en", "b", 1),
        (5, "one two three four five six", "en", "b", 1), (None, "one two three four five six", None, None, 1),
        (None, None, None, None, None), (6, "word " * 50, "en", "a", 250), (7, "a b", "en", "c", 3),
        (8, "A B", "en", "c", 3), (9, "mail joe.b7@ex.com or +1 (988) 555-2485 now", "en", "c", 3),
    ]
    clash = ("x",) * 7
    return spark.createDataFrame(
        [r + clash for r in rows], f"doc_id long, text string, lang string, source string, n_chars long, {CLASH}"
    )


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)


@pytest.fixture(scope="session")
def some_labels(spark):
    rows = [(i, int(i % 3 == 0), int(i % 4 == 0)) for i in range(30)] + [(None, 1, 1), (5, None, None), (5, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
