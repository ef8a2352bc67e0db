"""Small documents with every odd case that an operator must take."""

import pytest

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, columns with clashing names."""
    prose = "the quick brown fox jumps over the lazy dog and runs far away from the old house near the river "
    rows = [
        (1, prose * 6, "en", "a"),
        (1, prose * 6, "en", "a"),  # a repeated row
        (2, prose * 6, None, None),  # the same text
        (3, None, "en", "a"),
        (4, "", "fr", "a"),
        (None, "some text without an id " * 12, "en", "b"),
        (None, "some text without an id " * 12, "en", "b"),
        (None, None, None, None),
        (5, LONG, "de", "a"),
        (6, " \t\n\x0b\x0c\r ", "de", "a"),
        (7, "12 34 !!", "de", "a"),
        (7, "the same id with another text", "de", "a"),
        (8, "Éléphant ñandú 漢字 😀\nline two\n\nline two", "fr", "a"),
    ]
    schema = "doc_id long, text string, lang string, source string"
    frame = spark.createDataFrame(rows, schema).repartition(3)
    for name in ("id", "row", "size", "n", "class", "kept", "hash", "n_words", "shard", "spans", "__hash", "place"):
        frame = frame.selectExpr("*", f"'clash' AS `{name}`")
    return frame


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
