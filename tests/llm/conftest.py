import public_tokenizers
import pytest
from pyspark.sql import functions as F

LONG = "word " * 30_000 + "\n" + "endless" * 20_000
#: Null, empty and very long texts, ties, repeated rows and ids, and no id.
ODD = [
    (1, "", "en", "a"),
    (2, None, None, None),
    (3, LONG, "en", "a"),
    (4, "  \n\t ", "en", None),
    (5, "one two three four five six seven eight nine ten eleven", "en", "b"),
    (5, "one two three four five six seven eight nine ten eleven", "en", "b"),
    (6, "one two three four five six seven eight nine ten eleven", "en", "b"),
    (7, "one two three four five six seven eight nine ten twelve", "fr", "b"),
    (None, "one two three four five six seven eight nine ten eleven", None, "c"),
    (8, "Émile à la plage <|end|> [INST] & </s> \u0000 🙂", "fr", "c"),
]
#: Columns that operators may use inside.
CLASHING = ["id", "key", "n", "rank", "doc", "at", "size", "count", "shard", "kept", "drop", "copies", "__text"]


@pytest.fixture(scope="session")
def odd_docs(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string")
    return docs.withColumns({c: F.lit(f"own {c}") for c in CLASHING})


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def some_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def vocabulary():
    return public_tokenizers.path
