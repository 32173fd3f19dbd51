import pytest

from llm.prose import prose

LONG_WORDS = 30_000


@pytest.fixture(scope="session")
def messy_rows():
    """Nulls in every column, empty, blank and very long texts, ties and repeated rows."""
    base = prose(1, 120)
    near = base.split()
    near[60] = "changed"
    rows = [
        (1, base, "en", "a", 1),
        (2, " ".join(near), "en", "a", 1),
        (3, base, "en", "b", 1),
        (4, prose(2, 80), "de", "b", 1),
        (5, "", "de", "b", 0),
        (6, None, None, None, None),
        (7, " \t\n\x0b\x0c\r ", "en", "a", 1),
        (8, "one two three", "en", "a", 13),
        (9, "One TWO three", "en", "c", 13),
        (None, prose(3, 70), "en", None, 5),
        (None, None, "en", "c", 5),
        (10, prose(4, 60), "en", "c", 5),
        (10, prose(4, 60), "en", "c", 5),
        (11, prose(5, LONG_WORDS), "fr", "a", 5),
        (12, "é́ \U0001f600 <|endoftext|> \x1c x ▁y", "fr", "d", 5),
        (13, "same word " * 200, "fr", "d", 5),
        (14, "x" * 50_000, "fr", "d", 5),
    ]
    return rows


@pytest.fixture(scope="session")
def messy(spark, messy_rows):
    return spark.createDataFrame(messy_rows, "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def empty(messy):
    return messy.limit(0)


@pytest.fixture(scope="session")
def clashing(messy):
    """The same table with columns whose names operators may use themselves."""
    from pyspark.sql import functions as F

    names = "id fp1 fp2 n size k block p base copies nth part bucket component kept words n_words rule ids rank score held_out"
    return messy.select("*", *[F.lit(1).alias(n) for n in names.split()])
