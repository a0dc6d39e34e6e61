import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls, empties, ties, repeated rows, a long text, copies, and columns whose names clash but for case."""
    base = " ".join(f"word{i}" for i in range(120))
    near = base.replace("word119", "Other")
    rows = [(1, base), (2, base), (3, near), (4, None), (5, ""), (6, "  \n "), (7, "one two"), (7, "one two"), (8, "x " * 3 + base), (None, base), (9, "Ünï 日本 <|endoftext|> it's"), (10, " ".join(f"w{i % 977}x{i}" for i in range(6000)))]
    return spark.createDataFrame([(i, t, "en", "s", "extra") for i, t in rows], "doc_id long, text string, lang string, source string, TEXT string")


@pytest.fixture(scope="session")
def empty(docs):
    return docs.where("1 = 0")
