"""From documents to packed training sequences, stage by stage.

Every stage is a function (spark, docs, folder) -> DataFrame and works on all that the one before kept. All but the
last return the columns of `documents`, with `n_chars` brought up to date where texts change.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.llm import mixing, neardup, packing, pii, toxicity
from cartloom.session import stage

#: Not expressible in SQL: a trained classifier, pseudorandom draws and a vocabulary file.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Without the documents that the classifier rejects."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{folder}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near copies: texts that share four fifths of their runs of five words."""
    return neardup.without_copies(docs, neardup.FIVE_WORDS)


def mask_personal_data(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Personal data replaced by its kind."""
    clean = pii.masked(docs)
    if dict(docs.dtypes).get("n_chars") == "bigint":
        clean = clean.withColumn("n_chars", F.length("text").cast("bigint"))
    return clean


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents and parts of documents that the mix takes, as often as it takes them."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Every piece with its place in a sequence."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_copies),
    ("personal_data", mask_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over the documents table; each stage's result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, folder), f"pipeline-{name}")
    return docs
