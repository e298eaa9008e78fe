import pytest

#: Columns of documents, and others whose names the operators use for their own.
ODD = ("doc_id bigint, text string, lang string, source string, n_chars bigint, fp bigint, "
       "score double, size string, taken string, root string, th bigint, spans string, "
       "component_id string, key string, target double, quality int, toxic int, rid string")
LONG = " ".join(f"word{i % 97} and{i % 31} of{i % 13}" for i in range(30_000))


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing names."""
    prose = "the cat sat on the mat and looked at the dog that sat by the old green door"
    rows = [
        (1, prose, "en", "a", len(prose)),
        (1, prose, "en", "a", len(prose)),
        (2, prose, "en", "b", len(prose)),
        (2, "another text under the same id", None, None, 30),
        (3, None, "en", "a", None),
        (4, "", None, "", 0),
        (5, " \t\n", "de", None, 3),
        (None, prose + " again", "en", "a", 5),
        (None, None, None, None, None),
        (None, None, None, None, None),
        (6, LONG, "en", "c", len(LONG)),
        (7, "one", "fr", "b", 3),
        (8, "12345 !!! 678", "en", "b", 13),
        (9, "Ünï çödé — naïve “quotes” 😀 ünï", "de", "c", 32),
    ]
    extra = (5, 0.5, "s", "t", "r", 7, "x", "c", "k", 1.0, 1, 0, "r")
    return spark.createDataFrame([r + extra for r in rows], ODD)


@pytest.fixture(scope="session")
def none(odd):
    """The same columns without a row."""
    return odd.limit(0)
