"""Fixtures of these tests; a conftest.py here would hide the one above."""

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside.
CLASHING = ("stretch", "rank", "key", "th", "h", "rest", "size", "taken", "node", "fp", "rep", "_id", "_row", "_part", "start", "kept")


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source), over several partitions."""

    def build(*rows, schema=SCHEMA):
        full = [(r[0], r[1], *(r[2:] or ("en", "s")), len(r[1]) if r[1] is not None else None) for r in rows]
        return spark.createDataFrame(full, schema).repartition(3)

    return build


@pytest.fixture
def clashing():
    """The same documents with more columns, named like what operators make."""

    def widen(df):
        from pyspark.sql import functions as F

        return df.withColumns({c: F.lit("x") for c in CLASHING})

    return widen


@pytest.fixture
def odd(docs):
    """Nulls, empty and white texts, a very long text, ties and repeated rows."""
    long = " ".join(f"word{i % 977}" for i in range(30_000))
    return docs(
        (1, None),
        (2, ""),
        (3, " \t\n"),
        (4, "one"),
        (4, "one"),
        (4, "another text under the same id"),
        (None, "no id at all, but a text of its own"),
        (None, None),
        (5, long, None, None),
        (6, long + " end", None, "s"),
        (7, "naïve café 日本語 <|endoftext|>  tail ", "fr", "t"),
        (-8, "a b c d e f g h i j k l", "", ""),
    )
