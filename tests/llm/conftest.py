import pytest

DOCS = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, score STRING, copies STRING, row_key STRING, size STRING"
LONG = "lorem ipsum dolor sit amet " * 60_000


def frame(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * 4) for r in rows], DOCS)


@pytest.fixture(scope="session")
def edges(spark):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, extra columns."""
    rows = [
        (1, "a b c d e f g h", "en", "s1", 15),
        (2, "a b c d e f g h", "en", "s1", 15),
        (2, "a b c d e f g h", "en", "s1", 15),
        (3, " a b c\td e f g h\n", "en", "s2", 17),
        (4, None, None, None, None),
        (5, "", "de", None, 0),
        (6, " \n\t", None, "s2", 3),
        (None, "no id here, none at all", "en", "s1", None),
        (None, None, None, None, None),
        (7, LONG, "la", "s3", len(LONG)),
        (8, "Zwölf Boxkämpfer jagen Viktor quer über den großen Sylter Deich", "de", "s3", 63),
        (9, "12 34 -- !!", "en", "s3", 11),
    ]
    return frame(spark, rows)


@pytest.fixture(scope="session")
def empty(spark):
    return frame(spark, [])


@pytest.fixture(scope="session")
def small(spark):
    return "/root/testdata/sf0.001"
