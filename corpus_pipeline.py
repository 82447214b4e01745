"""A training-data pipeline over `documents`.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and reread for the next stage.
All stages but the last return the columns of `documents`.

1. language: documents whose language the classifier rejects go.
2. near_dedup: one document of each near-duplicate group stays.
3. pii: personal data in the text is masked; n_chars follows.
4. mixing: sources are mixed to their target weights, by whole documents.
5. pieces: texts are encoded as SentencePiece ids (comma-joined) and decoded
   again for the digest.

An empty table passes through all stages as an empty table; null texts are rejected by
the first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from duka.llm import langid, mixing, neardup, pieces, pii
from duka.llm.scratch import Scratch

# no single SQL statement can express compression, sketches, the random field or segmentation
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.identified(docs, langid.train(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.deduplicated(docs, Scratch(spark, "pipeline-neardup"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode(docs, keep_text=True).drop("decoded")


STAGES = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("pii", personal_data),
    ("mixing", mix_sources),
    ("pieces", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written and reread."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = scratch.cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
