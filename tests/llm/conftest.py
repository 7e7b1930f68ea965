import pytest

#: Nulls in each column, empty and blank texts, one long text, repeated rows, ties, and a column whose name clashes.
LONG = " ".join(f"tok{k % 997} of.the {k}" for k in range(12000))
ROWS = [
    (1, "Hello World. Hello world.\nthird line", "en", "s", 10, "x"),
    (2, None, None, None, None, None),
    (3, "", "en", "s", 0, "y"),
    (4, "  \n\t\n ", "en", "s", 5, "y"),
    (None, "no id here at all", "en", "s", 1, "z"),
    (5, LONG, "en", "s", len(LONG), "z"),
    (6, "same text twice " * 20, "en", "s", 1, None),
    (6, "same text twice " * 20, "en", "s", 1, None),
    (7, "same text twice " * 20, "fr", "t", 1, None),
    (8, "Released under the MIT License. mit license, MIT\nLicense", "en", "s", 1, None),
    (9, "é" * 300 + " ÀÉ über Straße 日本語 \x1c \x85 x", "de", "s", 1, None),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string"


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def plain(documents):
    return [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
