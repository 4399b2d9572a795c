import pytest

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 997}" for i in range(30_000))
PASSAGE = "the quick brown fox jumps over the lazy dog while seven wizards quietly fix the old gate near our house today again"

#: Nulls in every column, empty and blank and very long texts, repeated rows and ids, ties, other kinds of white space.
ROWS = [
    (1, PASSAGE + " first ending words here", "en", "a", 10),
    (2, PASSAGE + " first ending words here", "en", "a", 10),
    (3, PASSAGE.replace("wizards", "witches") + " and then quite another ending of this text", "en", "b", None),
    (4, None, "en", "a", None),
    (5, "", None, None, 0),
    (6, " \t\n\x0b\x0c\r ", "fr", "b", 7),
    (7, LONG, "en", "c", len(LONG)),
    (8, LONG + " tail", "en", "c", len(LONG)),
    (9, "two words", "de", "b", 9),
    (9, "two words", "de", "b", 9),
    (10, "ÉTÉ naïve 🙂 ßtraße", "fr", None, 3),
    (None, "a text without an id at all", "en", "a", 1),
    (None, None, None, None, None),
    (-5, "negative id " + PASSAGE, "en", "\U0001f600", 4),
    (2 ** 40, "one", "en", "B", 3),
]


@pytest.fixture(scope="session")
def odd(spark):
    """The odd documents with further columns, named like what operators use inside."""
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(ROWS, DOCUMENT)
    extra = ["node", "key", "size", "row", "text_key", "overlaps", "taken", "component", "_row", "_id", "_kept", "part", "label", "x"]
    return docs.select("*", *[F.lit(f"clash-{c}").alias(c) for c in extra]).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCUMENT)
