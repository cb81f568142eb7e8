import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def real(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumn("size", F.lit("clash")).cache()


@pytest.fixture(scope="session")
def odd(spark):
    """Null, empty, long, repeated and unlabelled rows."""
    long_ = " ".join(f"word{k % 977}" for k in range(30_000))
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (None, "some text of no document id here", "en", None, 3), (4, "x" * 50_000, "en", "b", 1), (5, long_, "de", "b", 2), (5, long_, "de", "b", 2), (6, long_, "de", "a", 2), (7, " \t\n ", "fr", "a", 4), (8, "12 34 ...", "fr", "", 1)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)
