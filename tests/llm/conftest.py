import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
ROOT = os.path.dirname(os.path.dirname(HERE))
sys.path[:0] = [HERE, ROOT]
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])     # for the Python workers

SF = os.environ.get("TOKSCOPE_TEST_SF", "/root/testdata/sf0.001")
DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = "Palabra larga und weiter the end. " * 6_000
ODD = [
    (1, None, "en", "s", 0), (2, "", "en", "s", 0), (3, "  \t\n ", None, None, 4), (None, "the cat and the dog sat there", "en", "s", 3),
    (None, None, None, None, None), (4, "the cat and the dog sat there", "en", "s", 3), (4, "the cat and the dog sat there", "en", "s", 3),
    (5, "123 456 !!! ###", "de", "t", 9), (6, LONG, "es", "t", 9), (7, "KK İstanbul MIT License café \U0001f600  x", "fr", None, 1),
    (8, "x", "en", "s", 1), (9, "General PUBLIC license, apache\nlicense. mit license mit license", "en", "s", 1), (100, "und der Hund", "de", "t", 2),
    (10, "released under the MIT license <|endoftext|> don't", "en", "s", 1), (11, "a" * 50_000, "en", "s", 1),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, DOC).repartition(3)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOC)


def clashing(docs):
    """The documents with more columns, named like columns that operators make."""
    from pyspark.sql import functions as F
    names = ("score", "fp", "th", "topic", "tokens", "draw", "u", "key", "root", "h", "rank", "_1", "p", "a", "words")
    return docs.select("*", *(F.lit("no").alias(c) for c in names))
