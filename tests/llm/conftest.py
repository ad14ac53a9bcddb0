import pytest
from pyspark.sql import Row
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
LONG = "the quick brown fox jumps over the lazy dog " * 5000

#: Columns whose names operators might use themselves.
CLASHES = ["score", "t", "h", "fp", "row", "z", "spans", "key", "size", "copies", "target", "component_id", "n", "copy", "rank"]
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
                     *[T.StructField(c, T.StringType()) for c in CLASHES]])
HARD = [
    (1, "hello world, this is a text", "a"), (2, None, None), (3, "", "b"), (4, " \n\t ", "b"), (None, "an id is missing here", "a"),
    (5, LONG, "c"), (6, LONG, "c"), (7, "same row " * 70, "a"), (7, "same row " * 70, "a"), (8, "żółć 漢字 \U0001f600 <|endoftext|> \x1c\x85x", "d"),
    (None, None, None), (9, "word", "e"), (10, "hello world, this is a text", "a"),
]


def _docs(spark, rows):
    return spark.createDataFrame([(i, x, "en", s, len(x or ""), *["x"] * len(CLASHES)) for i, x, s in rows], DOCS)


@pytest.fixture()
def make_docs(spark):
    return lambda rows: _docs(spark, rows)


@pytest.fixture()
def hard(spark):
    return _docs(spark, HARD)


@pytest.fixture()
def nothing(spark):
    return _docs(spark, [])


@pytest.fixture(scope="session")
def corpus(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def rows(df) -> list[Row]:
    return df.collect()
