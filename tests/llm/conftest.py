import pytest

from basketlens.llm.workers import find_package

EDGE = [
    (9000, "a" * 401), (9001, "cd" * 200), (9002, "ab" * 300), (9003, "x" + "ab" * 230), (9004, None), (9005, ""),
    (9006, " \n\t "), (9007, "éÀ " * 60), (9008, "one two"), (9009, "one two"), (9009, "one two"), (9010, "l1\nl1\n\nl2 <b>|&\nl1"),
    (9011, "  two  spaces \n and　wide <|endoftext|> "), (9012, "日本 語 123 !?"), (None, "a row without an id"),
]
DDL = "doc_id long, text string, lang string, source string, n_chars long, block long, length int, hash string"


@pytest.fixture(scope="session")
def docs(spark):
    """The smallest documents with odd rows and columns that clash."""
    find_package(spark)
    own = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"], 1, 2, "h") for r in own]
    rows += [(i, t, "en", None, len(t or ""), None, None, None) for i, t in EDGE]
    return spark.createDataFrame(rows, DDL).repartition(3).cache()


@pytest.fixture(scope="session")
def plain(docs):
    return [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]


@pytest.fixture
def nothing(docs):
    return docs.limit(0)
