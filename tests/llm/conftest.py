import pytest

from tagloom.llm.ship import ship

TRICKY = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one"),
    (5, "it's <|endoftext|>. café! ½. İ. x². A.B ▁ 日本. \x00 ..."),
    (6, "the same words come here again and again " * 40),
    (7, "the same words come here again and again " * 40),
    (7, "the same words come here again and again " * 40),
    (8, "line of text that repeats\n" * 30),
    (9, "aé" * 3000),
    (10, " ".join(f"w{i}" for i in range(60000))),
    (None, "a document without an id but with words enough to count as one of them"),
]


@pytest.fixture
def tricky(spark):
    """Nulls, empty, very long and repeated texts, a null id and columns with clashing names."""
    ship(spark)
    rows = [(i, t, "en" if (i or 0) % 2 else None, None, 5, "x") for i, t in TRICKY]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, ids string")
