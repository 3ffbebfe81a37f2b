import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

#: Nulls in any column, empty and blank texts, repeated rows, one id twice, and a text of some length.
ODD = [
    (1, "one two three four five six seven eight nine ten eleven twelve", "en", "a", 61),
    (2, None, None, None, None),
    (3, "", "en", "a", 0),
    (4, " \n\t ", "en", None, 4),
    (5, "one two three four five six seven eight nine ten eleven twelve", "en", "a", 61),
    (5, "one two three four five six seven eight nine ten eleven twelve", "en", "a", 61),
    (6, "été ß 日本語   x y 'tis it's <|endoftext|> a  b", "fr", "b", 40),
    (7, "word " * 30_000, "en", "b", 150_000),
    (None, "a document without an id", "en", "b", 24),
]


@pytest.fixture()
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture()
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture()
def documents(spark):
    """(id, text) rows as documents."""

    def build(rows):
        return spark.createDataFrame([(i, text, "en", "s", len(text or "")) for i, text in rows], SCHEMA).repartition(3)

    return build
