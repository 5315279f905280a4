import pytest

EN = "the quick brown fox jumps over the lazy dog while nine old men watch from a green hill near town"


def words(start: int, n: int) -> str:
    return " ".join(f"w{i}" for i in range(start, start + n))


@pytest.fixture()
def awkward(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and extra columns with awkward names."""
    rows = [
        (1, EN, "en", "a", 10, 5, "x"),
        (1, EN, "en", "a", 10, 5, "x"),
        (2, EN, None, "b", 10, 5, None),
        (3, None, "en", "a", None, None, None),
        (4, "", "en", None, 0, 5, "x"),
        (None, "some text without an id", "en", "a", 1, 5, "x"),
        (5, " \t\n \r\n", None, None, None, None, None),
        (6, "\n".join(words(i * 10, 10) for i in range(5000)), "en", "a", 1, 5, "x"),
        (7, "ñandú \U0001f600 </s>[INST] x\x00y", "es", "a", 1, 5, "x"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words long, doc long, rank string")


@pytest.fixture()
def empty(awkward):
    return awkward.limit(0)
