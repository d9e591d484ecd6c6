"""Small tables with everything that could trip an operator."""

import random

import pytest
from pyspark.sql import types as T

#: Names that operators use inside or in their results, on top of the columns of documents.
CLASHES = ["ids", "shard", "size", "fp", "recipe", "rank", "row", "component", "lang_pred", "score", "bits", "kept"]

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        *(T.StructField(c, T.StringType()) for c in CLASHES),
    ]
)

SYLLABLES = "the on er ing and tion ble re ha st".split()


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 3))) for _ in range(words)) + "."


def row(doc_id, text, lang="en", source="src0"):
    return (doc_id, text, lang, source, None if text is None else len(text), *CLASHES)


def awkward_rows():
    """Nulls, empty, blank and very long texts, repeated rows and doc_ids, other scripts, special strings."""
    return [
        row(1, prose(1, 60)),
        row(2, prose(1, 60)),
        row(3, prose(3, 80), None, None),
        row(3, prose(3, 80), None, None),
        row(4, None),
        row(5, ""),
        row(6, " \t\n "),
        row(7, "12345 67890 +-+"),
        row(8, "no " * 60_000),
        row(9, "x" * 150_000),
        row(10, "<|endoftext|> and <|endof" + "text|>" * 3),
        row(11, "日本語のテキスト。" * 40, "ja"),
        row(12, "Mail a.b@example.com or +1 (212) 555-0100, 4111 1111 1111 1111 at 10.0.0.1 🙂"),
        row(None, prose(4, 50)),
        row(None, None, None, None),
        row(-5, prose(5, 40), "de"),
        row(14, prose(14, 3)),
        row(14, prose(15, 30)),
    ]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def plain(spark, sf):
    """(doc_id, text) of the smallest documents table."""
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    return [(r[0], r[1] or "") for r in rows]
