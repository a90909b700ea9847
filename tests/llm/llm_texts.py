"""Random prose and messy rows for tests."""

import random

import pytest

from censa.llm.shared import shipped

WORDS = "the of and to in is it that was for on are as with his they at be this from".split()


def prose(n, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="session", autouse=True)
def package(spark):
    shipped(spark)


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls, empty and very long texts, ties, repeated rows and columns with the operators' own names."""
    a, b = prose(120, 1), prose(90, 2)
    near = a.split()
    near[50] = "changed"
    rows = [
        (1, a), (2, a), (2, a), (3, " ".join(near)), (4, b), (5, ""), (6, None), (None, b), (7, "one two"), (8, "  one\t\n two "),
        (9, prose(30_000, 3)), (10, "x" * 200_000), (11, prose(200, 4)), (12, "Ünïcode — 日本語 <|endoftext|> 'S it's"), (13, "\x1c\x1f \x85"),
    ]
    clash = ["row", "group", "sha", "key", "words", "part", "number", "maybe", "lang", "node", "block", "start", "near_row"]
    data = [(i, t, *["z"] * len(clash)) for i, t in rows]
    return spark.createDataFrame(data, "doc_id long, text string, " + ", ".join(f"{c} string" for c in clash)).repartition(3)


@pytest.fixture(scope="session")
def nothing(messy):
    return messy.limit(0)
