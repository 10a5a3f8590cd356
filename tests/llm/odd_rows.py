"""Fixtures shared by the tests of this folder."""

import random

import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


@pytest.fixture(scope="session")
def engine(spark):
    from wardenlake.llm.shared import prepare

    return prepare(spark)


@pytest.fixture(scope="session")
def odd(engine):
    """Documents with nulls, empty and long texts, repeated rows and extra columns with clashing names."""
    draw = random.Random(5)
    text = " ".join(draw.choice(WORDS) for _ in range(300)) + "."
    rows = [
        (1, text, "en", "a", 1.0, 7), (2, text, "en", "a", 1.0, 7), (3, None, None, None, None, None), (4, "", "en", "b", 0.0, 0),
        (5, " \n\t ", "de", "b", 0.5, 1), (None, text, "en", "a", 1.0, 2), (6, "x" * 200_000, "en", "c", 0.1, 3),
        (7, "one", "en", "c", 0.1, 3), (7, "one", "en", "c", 0.1, 3), (8, (text + "\n") * 200, "en", "c", 0.1, 3),
    ]
    return engine.createDataFrame(rows, "doc_id long, text string, lang string, source string, posterior double, rank long")


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("doc_id < 0")
