import pytest

#: Nulls, empty and long texts, repeats, equal ids, and columns whose names clash with those that operators use.
ROWS = [
    (1, "alpha beta gamma delta epsilon zeta", "en", "a"),
    (2, "ALPHA beta gamma delta epsilon zeta", "en", "a"),
    (2, "ALPHA beta gamma delta epsilon zeta", "en", "a"),
    (3, None, "de", "b"),
    (4, "", None, None),
    (5, " \t\n ", "fr", "b"),
    (6, "uno dos", "es", "é"),
    (7, "Ünïcode wörds here, İstanbul ẞ \U0001f600 end", "de", "b"),
    (8, "long " * 3000 + "tail", "en", "a"),
    (9, "x" * 20000, "en", "c"),
    (10, "alpha beta gamma delta epsilon eta", "en", "c"),
]


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(*r, 7, 8.0, "clash") for r in ROWS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, fp long, size double, id string")


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("1 = 0")
