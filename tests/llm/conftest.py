from __future__ import annotations

import pytest
from pyspark.sql import types as T

from quayload.llm.common import Files

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        # names that the operators use themselves
        T.StructField("key", T.StringType()),
        T.StructField("kept", T.IntegerType()),
        T.StructField("rid", T.DoubleType()),
        T.StructField("count", T.LongType()),
        T.StructField("cell", T.ArrayType(T.LongType())),
    ]
)
SF = "/root/testdata/sf0.001"


def words(start: int, n: int, sep: str = " ") -> str:
    return sep.join(f"w{(start * 7919 + i * i * 31 + i) % 100003}" for i in range(n))


@pytest.fixture
def files(spark):
    return Files(spark, "tests")


@pytest.fixture(scope="session")
def table(spark):
    """A table from (doc_id, text[, lang[, source]]) with extra columns of clashing names."""

    def make(rows):
        full = [(*row, *[None] * (4 - len(row)), "k", 7, 0.5, 3, [1]) for row in rows]
        return spark.createDataFrame(full, DOCS).repartition(3)

    return make


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls, empty and white-space texts, a very long one, ties, repeated rows, near and partial copies."""
    base = words(1, 120)
    long = words(2, 30_000)
    near = base.split()
    near[60] = "changed"
    passage = words(9, 40)
    return [
        (1, None, None, None),
        (2, "", "en", "src1"),
        (3, " \t\n\x0b\x0c\r", "en", "src1"),
        (4, base, "en", "src2"),
        (5, base, None, "src2"),
        (5, base, None, "src2"),
        (6, " ".join(near), "de", None),
        (7, long, "de", "src3"),
        (8, long + "\n", "de", "src3"),
        (9, words(3, 60) + " " + passage + " " + words(4, 50), "fr", "src4"),
        (10, words(5, 30) + " " + passage + " " + words(6, 80), "fr", "src4"),
        (11, "one two", "en", "src0"),
        (12, "One  TWO", "en", "src0"),
        (13, "No " * 300, "en", "src0"),
        (14, "été 漢字 \U0001f642 " * 20, "fr", "src5"),
        (None, base, "en", "src0"),
        (None, words(8, 30), "en", "src0"),
        (15, "12345 67890 !!", "en", "src0"),
    ]
