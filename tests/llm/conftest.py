from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def prose(seed: int, n: int) -> str:
    """Some words that no other seed is likely to put together."""
    rng = random.Random(seed)
    parts = ["ka", "lo", "mi", "ne", "ru", "ta", "vo", "si", "pe", "du", "é", "ñ"]
    return " ".join("".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="session")
def docs_of(spark):
    def make(rows):
        """Documents from ``(doc_id, text)``."""
        full = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture(scope="session")
def edge_rows():
    """NULLs, empty and blank texts, ties and repeated rows, and a very long text."""
    return [
        (1, "Hello there, plain text."),
        (2, None),
        (3, ""),
        (4, " \n\t "),
        (5, prose(1, 40)),
        (5, prose(1, 40)),
        (None, prose(2, 30)),
        (None, None),
        (7, prose(3, 30_000)),
        (8, "x" * 5_000),
        (9, "<|endoftext|> \U0001f600 don't \x1c \xa0"),
    ]


