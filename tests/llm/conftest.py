import pytest

ROWS = [
    (1, "The cat sat on the mat and the dog lay down.", "x"), (2, "The cat sat on the mat and the dog lay down.", "y"),
    (3, None, None), (4, "", "z"), (5, "one", None), (6, "the cat sat on the mat and the dog lay down. Then", "w"),
    (7, "a b c d e f g h " * 3000, "long"), (7, "a b c d e f g h " * 3000, "long"), (None, "no identifier here", "n"),
    (8, "  spaced \t out\n\nlines é ñ 漢字 <s> ", "s"), (9, "!!! ### $$$", "k"),
]


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls, empty and long texts, repeated rows, and a column that clashes with a working column's name."""
    return spark.createDataFrame(ROWS, "doc_id long, text string, kept string")


@pytest.fixture(scope="session")
def none(docs):
    return docs.limit(0)
