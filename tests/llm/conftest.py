import pytest
from pyspark.sql import types as T

from atlaspanel.llm.queries import tokenizer_path

DOCS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
)
#: Nulls in every column, empty and blank texts, repeated rows, equal texts, special strings, runs of blanks, a very long text.
ODD = [
    (None, None, None, None, None),
    (1, None, "en", "a", None),
    (2, "", "en", "a", 0),
    (3, " \n\t ", None, "a", 4),
    (4, "one", "en", None, 3),
    (5, "one two", "en", "b", 7),
    (6, "Alpha beta\ngamma delta, alpha beta", "en", "b", 34),
    (6, "Alpha beta\ngamma delta, alpha beta", "en", "b", 34),
    (7, "Alpha beta\ngamma delta, alpha beta", "de", "b", 34),
    (None, "Alpha beta\ngamma delta, alpha beta", "de", "b", 34),
    (8, "a <|endoftext|> b  c \n d ▁ é ½ 日本 <s> ", "fr", "c", 10),
    (9, "lorem ipsum dolor sit amet " * 4000, "fr", "c", 108000),
    (10, "".join(f"w{i} " for i in range(3000)), "fr", "c", 17890),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clashing(spark, odd_docs):
    """The odd documents with further columns named like the operators' own."""
    from pyspark.sql import functions as F

    names = ["__row", "__id", "__size", "__copy", "__content", "fp", "size", "score", "kept", "n_tokens", "rank", "shard", "length", "content", "id"]
    return odd_docs.withColumns({n: F.lit("x") for n in names})


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def bpe():
    return tokenizer_path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def pieces():
    return tokenizer_path("piece_bpe_32k.model")
