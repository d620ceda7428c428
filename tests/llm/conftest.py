import re

import pytest

from ledgerline.llm.common import LOWER, UPPER, WORD

SF = "/root/testdata/sf0.001"


def words(text):
    """The words of a text, by the plain definition."""
    return re.findall(WORD, (text or "").translate(str.maketrans(UPPER, LOWER)))


@pytest.fixture(scope="session")
def documents(spark):
    """The small documents, with edge cases: null, empty, no words, repeated rows and a null id."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    one = docs.orderBy("doc_id").first()
    edge = [(900001, None, "en", "s", None), (900002, "", "en", "s", 0), (900003, "?! ...", None, "s", 6),
            (900004, "two words", "en", None, 9), (900005, "Two; WORDS!", "en", "s", 11), (900006, "word " * 3000, "en", "s", 15000),
            (None, "a text without an id, long enough to have some words in it", "en", "s", 58),
            (900007, "z" * 30000, "en", "s", 30000), (one.doc_id, one.text, one.lang, one.source, one.n_chars),
            (900008, one.text, one.lang, one.source, one.n_chars)]
    return docs.unionByName(spark.createDataFrame(edge, docs.schema)).cache()


@pytest.fixture(scope="session")
def clashing(documents):
    """The documents with extra columns whose names the operators use themselves."""
    from pyspark.sql import functions as F
    names = ["id", "ref", "w", "spans", "node", "class_id", "own", "k1", "k2", "n", "r1", "r2", "key", "score", "kept"]
    return documents.withColumns({c: F.lit("x") for c in names})
