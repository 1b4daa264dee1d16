import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Cases that every operator must take: null and empty texts, blanks only,
#: null ids and sources, repeated rows, a very long text.
ODD_TEXTS = [None, "", " \t\n", "one", "a b c d e", "x " * 50_000, "é ü ñ z   q", "\n\n\n"]


@pytest.fixture()
def make_docs(spark):
    def make(texts, ids=None, sources=None):
        ids = ids or list(range(len(texts)))
        sources = sources or ["web"] * len(texts)
        rows = [(i, t, "en", s, len(t) if t is not None else None) for i, t, s in zip(ids, texts, sources, strict=True)]
        return spark.createDataFrame(rows, DOCS)

    return make


@pytest.fixture()
def odd_docs(spark, make_docs):
    """ODD_TEXTS, a null id, two equal rows, and columns whose names the
    operators use themselves."""
    docs = make_docs([*ODD_TEXTS, "null id text here", "same row twice", "same row twice"], [*range(len(ODD_TEXTS)), None, 90, 90], [None, "a", "b", "a", None, "a", "b", "c", "a", "b", "b"])
    for clash in ("size", "score", "hash", "c", "n", "key", "kept", "id", "own", "taken", "features", "label"):
        docs = docs.withColumn(clash, F.lit(clash))
    return docs


@pytest.fixture()
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture()
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
