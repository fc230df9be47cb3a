import random

import pytest

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))


@pytest.fixture(scope="session")
def edge_documents(spark):
    """Null, empty, very long, tied and repeated texts; a null id; extra columns with clashing names."""
    rows = [
        (1, None), (2, ""), (3, "word"), (3, "word"), (None, "a text without an id and some more words"),
        (4, LONG), (5, LONG + " tail"), (6, "  \t\n "), (7, "Ünïcode Wörds ÀÉ 漢字 and ASCII Words"), (8, "word"),
        (9, "one two three four five six"), (10, "one two three four five six"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.selectExpr("doc_id", "text", "'en' lang", "1 n", "'x' term", "2.5 score", "doc_id node", "'h' h1", "1 signature", "'b' block", "0 hits")


@pytest.fixture
def words():
    pick = random.Random(5)
    known = ["".join(pick.choice("aeioustrnm") for _ in range(pick.randint(2, 7))) for _ in range(900)]
    return lambda n: " ".join(pick.choice(known) for _ in range(n))


@pytest.fixture(scope="session")
def empty_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, n int")
