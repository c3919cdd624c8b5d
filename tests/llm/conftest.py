import random

import pytest
from helpers import make, words


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls in every column, empty and blank texts, a very long one, copies, near copies, repeated rows."""
    rng = random.Random(7)
    rows = [(0, None, None, None), (1, "", "en", "a"), (2, " \n\t ", "en", "a"), (3, "word", None, "a"), (4, "word", "en", "b")]
    rows += [(None, "no id at all", "en", "a"), (None, None, None, None)]
    rows.append((10, " ".join(words(rng, 60_000, 5000)), "en", "a"))
    base = words(rng, 120)
    for i in range(20, 40):
        copy = list(base)
        for _ in range(rng.randrange(0, 8)):
            copy[rng.randrange(len(copy))] = "changed"
        rows.append((i, " ".join(copy) + "\nthe same footer\nthe same footer", "en", "a"))
    for i in range(50, 90):
        rows.append((i, "\n".join(" ".join(words(rng, rng.randrange(1, 30))) for _ in range(rng.randrange(1, 8))) + "\nthe same footer", rng.choice(["en", "de", None]), rng.choice("ab")))
    rows += [(50, rows[-40][1], "en", "a")] * 3 + [(95, "É é ñ 漢字 " * 50, "fr", "c"), (96, "1234 5678 !!", "en", "c")]
    return rows


@pytest.fixture(scope="session")
def docs(spark, messy):
    return make(spark, messy).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return make(spark, [])
