from __future__ import annotations

import random
import tempfile

import pytest
from pyspark.sql import types as T

from terrace.llm.common import ship

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
SYLLABLES = {"en": "the ing on er th ed and is".split(), "de": "sch ung keit ein über der ß".split(), "fr": "eau é que ment oi ê les".split()}


def words(rng: random.Random, lang: str, n: int) -> str:
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3))) for _ in range(n))


def sentences(rng: random.Random, lang: str, n: int) -> str:
    return "\n".join(words(rng, lang, rng.randint(4, 12)).capitalize() + "." for _ in range(n))


@pytest.fixture(autouse=True, scope="session")
def _shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def rows():
    """Documents in three languages with every odd case: nulls, empty and long texts, copies, repeated rows."""
    rng = random.Random(7)
    out = []
    for i in range(60):
        lang = ("en", "en", "de", "fr")[i % 4]
        text = sentences(rng, lang, rng.randint(1, 8))
        out.append((i, text, lang, ("s0", "s0", "s1", "s2", None)[i % 5]))
    out += [(100 + i, out[i][1], out[i][2], "s1") for i in range(5)]  # exact copies
    out += [
        (200, None, "en", "s0"),
        (201, "", "de", "s1"),
        (202, " \n\t ", "fr", "s2"),
        (203, "123 456 !!", "en", "s0"),
        (204, sentences(rng, "en", 900), "en", "s2"),  # longer than others by far
        (205, "x" * 50_000, None, "s0"),
        (None, words(rng, "de", 30), "de", "s1"),
        (206, words(rng, "en", 20), None, None),
        (207, "Ärger \U0001f600 naïve text, twice. Ärger", "de", "s3"),
        (208, "A b", "en", "s3"),
    ]
    out += [(300, "the same row again and again", "en", "s0")] * 3
    return [(*r, None if r[1] is None else len(r[1])) for r in out]


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture()
def sf_dir(spark, docs):
    """The documents as a table folder, for queries that read tables."""
    folder = tempfile.mkdtemp(prefix="terrace-test-")
    docs.write.parquet(f"{folder}/documents.parquet")
    return folder
