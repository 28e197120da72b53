import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def documents(spark):
    """A documents table of (doc_id, text) pairs, in several partitions."""
    def build(rows, partitions=3):
        full = [(i, t, "en", "src", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, DOCUMENTS).repartition(partitions)
    return build


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty, blank, short, long, tied and repeated texts, and letters of several bytes."""
    long_text = " ".join(f"word{i % 700} naïve{i % 13}" for i in range(30_000))
    return [
        (0, None), (1, ""), (2, " \t\n"), (3, "one"), (4, "one two"), (5, "one two three"),
        (6, "Straße été 日本語 \U0001F600 end"), (7, "same text of some length " * 12), (8, "same text of some length " * 12),
        (9, "same text of some length " * 12 + "x"), (9, "another text under the same id"), (10, long_text),
        (11, "twice"), (11, "twice"), (None, "no id"), (None, "no id"), (None, None),
        (12, "ÄÖÜ " * 90 + "<|endoftext|> tail"), (13, "a" * 700), (14, "a" * 500), (15, "x\n\nx\ny\nx\n"),
    ]
