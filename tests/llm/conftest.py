"""Tables with the awkward rows that every operator must take."""

import pytest

LONG = "long words go on and on " * 20_000

AWKWARD = [
    (1, "A few plain words, and a few more of them.\nAnd a second line.", "en", "s1", 7),
    (2, None, "en", "s1", 7),
    (3, "", None, "s1", 7),
    (4, " \t\n ", "en", None, None),
    (5, LONG, "en", "s2", 7),
    (6, "one", "fr", "s2", 7),
    (6, "one", "fr", "s2", 7),
    (None, "Words of a row without an id, which are five or more.", "en", "s1", 7),
    (8, "été 漢字 🙂 'll #tag", None, None, 7),
]


@pytest.fixture(scope="session")
def awkward(spark):
    """Rows with nulls, empty and long texts and repeats, with columns whose names clash with results."""
    df = spark.createDataFrame(AWKWARD, "doc_id long, text string, lang string, source string, score int")
    return df.selectExpr("*", "'x' as n_tokens", "1 as component", "2 as rank", "3.0 as target", "doc_id as node",
                         "0 as bin", "'y' as a", "'z' as n_words")


@pytest.fixture(scope="session")
def empty(awkward):
    return awkward.where("false")
