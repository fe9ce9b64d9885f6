import pytest
from pyspark.sql import types as T
from samples import PROSE

DOC = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # extra columns with the names that operators use themselves
    *[T.StructField(c, T.StringType()) for c in ("t", "w", "fp", "rid", "found", "spans", "ids", "kept", "clean", "k1", "id")]])


def doc(i, text, lang="en"):
    return (i, text, lang, "s", None if text is None else len(text), *["x"] * (len(DOC) - 5))


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows):
        """rows: (doc_id, text) or (doc_id, text, lang)."""
        return spark.createDataFrame([doc(*r) for r in rows], DOC)
    return make


@pytest.fixture(scope="session")
def edge_rows():
    """NULLs, empty and very long texts, ties, repeated rows."""
    long_ = " ".join(f"word{i % 5000} café" for i in range(60_000))
    return [(1, PROSE), (1, PROSE), (2, None), (None, PROSE), (None, None), (3, ""), (4, " \n\t "), (5, long_), (6, PROSE.upper()),
            (7, "ünïcödé 日本語 😀 " * 30), (8, "x"), (9, "\x00\r\n ▁ \\ \" '"), (10, PROSE + " " + PROSE)]


@pytest.fixture(scope="session")
def edge_docs(make_docs, edge_rows):
    return make_docs(edge_rows)


@pytest.fixture(scope="session")
def no_docs(make_docs):
    return make_docs([])
