"""Helpers of the llm tests: odd documents, and Spark sessions come from the parent folder."""

import random

import pytest

ODD = (
    [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one two three"), (6, "é漢😀 'tis 'S it's"), (7, "tie tie"),
     (8, "tie tie"), (8, "tie tie"), (None, "without an id"), (None, None), (9, "x" * 30_000), (10, "\n\n\n")]
)


@pytest.fixture
def odd(spark):
    """Null, empty, very long, repeated and tied rows, with further columns of clashing names."""
    rows = [
        (i, t, None, "s", 0, "x", 1.5, True, b"b", [1]) for i, t in ODD
    ]
    return spark.createDataFrame(
        rows,
        "doc_id long, text string, lang string, source string, n_chars long, keep_id string, score double, "
        "kept boolean, digest binary, ids array<int>",
    )


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture
def labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


def words(rng: random.Random, n: int, vocabulary: int = 400) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture
def frame(spark):
    def make(texts):
        return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")

    return make
