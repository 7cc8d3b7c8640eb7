"""A small hard corpus: nulls, empty and long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

import random

import pytest

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, tag string, token string, a string"


def prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("aeioulnrst") for _ in range(draw.randint(1, 8))) for _ in range(words))


def hard_rows() -> list[tuple]:
    shared = prose(99, 90)
    texts = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "One TWO"), (6, prose(1, 60)), (7, prose(1, 60)),
        (7, prose(1, 60)), (8, prose(2, 30) + "\n" + shared), (9, shared + "\n" + prose(3, 30)), (10, shared),
        (11, prose(4, 9000)), (12, "é" * 500), (13, "日本語 " * 200), (14, "1234 5678"), (None, prose(5, 40)),
        (15, prose(6, 120)), (16, prose(6, 120) + " tail"), (17, "a\nb\na\nb " * 40), (18, None),
    ]
    return [(i, t, "xx" if i and i % 2 else None, "s" if i != 6 else None, None, "r", "t", "k", "a") for i, t in texts]


@pytest.fixture(scope="session")
def hard(spark):
    return spark.createDataFrame(hard_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame(
        [(i, i % 2, 0, "extra") for i in range(20)] + [(None, 1, 0, ""), (3, None, 0, "")],
        "doc_id long, quality int, toxic int, text string",
    )
