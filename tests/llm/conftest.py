import pytest
from pyspark.sql import types as T

LONG = "lang und breit der wald steht still und schwarz " * 4000


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, repeated rows, and columns that operators use inside."""
    schema = T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
         T.StructField("n_chars", T.LongType()), T.StructField("row", T.LongType()), T.StructField("fingerprint", T.StringType()), T.StructField("part", T.IntegerType())]
    )
    texts = [
        (1, "The cat sat on the mat and the dog lay by the door of the house."), (2, None), (3, ""), (4, LONG), (5, "12345 --- !!!"), (6, "a"),
        (7, "The cat sat on the mat and the dog lay by the door of the house."), (7, "The cat sat on the mat and the dog lay by the door of the house."),
        (None, "Un chat est sur la table et il dort bien."), (9, "x  y\n\n\tz "), (10, "\n\n"), (11, "日本 語 テキスト é ü"),
    ]
    rows = [(i, t, "en" if i and i % 2 else None, None, None if t is None else len(t), 0, "x", 1) for i, t in texts]
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("1 = 0")


@pytest.fixture(scope="session")
def docs(spark, root):
    return spark.read.parquet(f"{root}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    """doc_id and text on the driver, for brute force."""
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
