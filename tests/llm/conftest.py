from __future__ import annotations

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

SMALL = "/root/testdata/sf0.001"
DOCUMENTS = StructType(
    [StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()), StructField("source", StringType())]
)


@pytest.fixture(scope="session")
def documents(spark):
    """The small documents table as rows of pandas."""
    return spark.read.parquet(f"{SMALL}/documents.parquet").toPandas()


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows and columns with clashing names."""
    long = "ein langes Wort und noch eins, it's a long   text\n\n" * 3000
    rows = [
        (None, None, None, None), (None, "same", "en", "a"), (None, "same", "en", "a"), (1, "", "en", "a"), (2, " \n", None, "a"),
        (3, long, "de", "b"), (4, long + " ", "de", None), (5, "sa me", "en", "b"), (6, "sa me", "en", "b"), (6, "sa me", "en", "b"),
        (7, "Ünï çødé   text's 123", "fr", "é"), (8, "one two three four five", "en", "a"),
    ]
    clash = "row id text_key key size ids shard slot kept score copies group_size n sha mark open end node".split()
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(rows, DOCUMENTS)
    return frame.select("*", *[F.lit("x").alias(c) for c in clash])


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)
