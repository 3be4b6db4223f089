from __future__ import annotations

import random

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()),
                   StructField("n_words", StringType()), StructField("kept", StringType())])


def passage(seed: int, n: int, size: int = 400) -> list[str]:
    rng = random.Random(seed)
    return [f"w{rng.randrange(size)}" for _ in range(n)]


@pytest.fixture(scope="session")
def odd_texts() -> list[tuple]:
    """(doc_id, text): nulls, empty, blank, long, tied, repeated and odd texts."""
    shared = passage(1, 60)
    base = passage(2, 150)
    near = list(base)
    near[70] = "other"
    rows = [
        (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "one two three four"),
        (6, "one two three four five six"), (7, " ".join(shared)),
        (8, " ".join(passage(3, 80) + shared + passage(4, 40))),
        (9, "\n".join(passage(5, 20) + shared)), (10, " ".join(base)), (11, " ".join(base)), (12, " ".join(near)),
        (12, " ".join(near)), (None, " ".join(base)), (None, None),
        (13, " ".join(["a"] * 100)), (14, "x" * 30_000 + " y"), (15, " ".join(passage(6, 9000, 5000))),
        (16, "café naïve — 日本語　テスト don't <|endoftext|> 12345 \u0085 x y"),
        (17, "line one\nline one\n\n \nline two\r\nline two\nline one"),
        (18, "ÉCOLE × ÷ 'S we'll A1B2"), (-5, "ONE two"), (19, "\n".join(["same words here"] * 30)),
    ]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_texts):
    """The odd texts with extra columns that clash with output names."""
    return spark.createDataFrame([(i, t, "extra", "clash") for i, t in odd_texts], DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
