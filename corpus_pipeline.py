"""The corpus pipeline: from raw documents to packed token ids, stage by stage.

Each stage takes the documents that the one before kept and returns a
DataFrame, which is written as Parquet in the shared folder and read again as
the next stage's input. All stages but the last return the columns of
``documents``, so a stage can be left out or run again on its own.

1. language_id: documents whose language can't be told go.
2. near_dedup: one document of each group of near copies stays.
3. decontamination: documents with a twentieth or more of their words inside
   benchmark windows go.
4. mixing: every document is taken as often, or in part, as its source's quota
   says; one row for each time.
5. packing: rows of 2048 token ids with segment lengths and positions.

Rows with nulls, empty texts and extra columns pass each stage as its
operator's docstring says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terrace.llm import decontamination, language, mixing, packing, simhash
from terrace.llm.common import id_remainder, materialize, ship, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    parser = language.learn(docs, id_remainder("doc_id", language.HELD_OUT) != 0)
    return language.keep_identified(docs, parser)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return decontamination.remove_spans(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return mixing.mixed_texts(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return packing.packed(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("packing", pack),
]

# Suffix automata, seeded block selection and byte-pair merges have no SQL form;
# tests/llm compares the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the packed rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
