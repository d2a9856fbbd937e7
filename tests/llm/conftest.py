import random

import pytest

from stormgrid.llm.texts import ship_package

SCHEMA = "doc_id long, text string, lang string, kept boolean, row string, id long, norm int"


def awkward_rows():
    """Nulls, empty and long texts, ties, repeated rows and ids, and columns named like results."""
    words = "the of and to a in is that for on with as it be this by are was not or".split()
    rng = random.Random(3)
    prose = lambda n: " ".join(rng.choice(words) + rng.choice(["", "ing", "er", "é"]) for _ in range(n))
    long = prose(6000)
    shared = prose(60)
    texts = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "One"), (6, "two words"), (7, "two  words"),
        (8, long), (9, long), (10, long + " end"), (11, shared), (12, prose(40) + " " + shared), (13, shared + " " + prose(40)),
        (14, "漢字 😀 é x"), (15, "a\r\nb\r\n\r\nc"), (16, "#*$% | <> & !!"), (17, "x" * 500), (18, "x" * 500 + "y"),
        (None, shared), (None, None), (20, "same id"), (20, "same id, other text"), (21, "again"), (21, "again"),
        (22, "<|endoftext|> and <|endoftext|>"), (23, "  lead and   trail  "), (24, "it's we'll 'tis 12 34"),
    ]
    return [(i, t, "en" if i and i % 2 else None, True, "r", 7, 1) for i, t in texts]


@pytest.fixture(scope="session")
def awkward(spark):
    ship_package(spark)
    return spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
