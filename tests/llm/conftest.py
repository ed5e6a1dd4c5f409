import pytest
from pyspark.sql import types as T

DOCUMENT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # Extra columns whose names the operators use themselves.
    T.StructField("node", T.StringType()), T.StructField("size", T.StringType()), T.StructField("row", T.StringType()),
    T.StructField("finding", T.StringType()), T.StructField("label", T.StringType()), T.StructField("h", T.StringType()),
])
BASE = [f"alpha{i} beta{i * 7 % 13} gamma{i % 5}" for i in range(40)]
LONG = " ".join(BASE)
CLEAN = "the quiet river runs past the old stone mill and children play near the water every summer evening"


def rows(*documents):
    """``(id, text, lang, source)`` as documents with clashing extra columns."""
    return [(i, t, lang, s, None if t is None else len(t), "x", "x", "x", "x", "x", "x") for i, t, lang, s in documents]


EDGES = rows(
    (1, LONG, "en", "a"), (2, LONG, "en", "a"), (2, LONG, "en", "a"), (3, None, "en", None), (4, "", None, "b"), (5, "   \n\t ", "en", "b"),
    (6, "one", None, None), (7, "... 123 ###", "en", "c"), (None, LONG, "en", "c"), (8, CLEAN, "en", "c"), (None, None, None, None),
    (9, CLEAN + " " + LONG, "en", "a"), (10, " ".join(["word"] * 30_000), "en", "a"), (11, "été où là señor größe ñ", "fr", "a"),
    (12, LONG.replace("beta", "delta"), "en", "a"),
)


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(EDGES, DOCUMENT).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCUMENT)
