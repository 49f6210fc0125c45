import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SCHEMA = "lang string, doc_id long, text string, n_tokens string, score int, text_key string"


@pytest.fixture
def corpus(spark):
    """Rows with nulls, empty texts, repeated rows, ties and columns whose names clash."""
    long = " ".join(f"word{i % 997}{'x' * (i % 7)}" for i in range(9000))
    base = " ".join(f"alpha{i} beta{i * 7 % 31}" for i in range(200))
    rows = [
        (1, None), (2, ""), (3, "   \n"), (4, "one"), (5, "one two"), (6, "One  two"), (7, long), (8, long),
        (8, long), (None, "one two"), (None, None), (9, base), (10, base + " tail"), (11, "other " + base),
        (12, base.replace("alpha77", "changed")), (13, "ünïcode 漢字 🙂 " * 60), (14, "a" * 5000), (15, "a b " * 900),
        (2, ""), (16, "x" * 399), (17, "prefix " + base[:450] + " suffix"),
    ]
    return spark.createDataFrame([("en", i, t, "clash", None, "clash") for i, t in rows], SCHEMA)


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
