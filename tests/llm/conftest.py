import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMALL = SF = "/root/testdata/sf0.001"  # one name with tests/conftest.py, whichever of both is found

# null, empty, blank, one word, odd white space, code points beyond the first plane, repeated rows, a long text
EDGES = [
    (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "word"), (5, "one two three \x1c four\x85five"),
    (6, "\U0001f600 été été Å"), (7, "same text here"), (7, "same text here"), (8, "same text here"),
    (None, "no id"), (9, "a b c d e " * 4000), (10, "x" * 70000),
]


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame([(i, t, 5) for i, t in EDGES], "doc_id long, text string, n long")


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string")
