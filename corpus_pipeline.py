"""Cleans `documents` in stages, each written as Parquet and read again by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from airmart.llm import decontaminate, jaccard, pieces, pseudonyms, queries, toxicity
from airmart.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5; null and empty texts score 0."""
    score = toxicity.score("text", queries.trained_on_labels(spark, docs, sf_dir))
    return docs.where(score < queries.TOXIC)


def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of similar documents one row, that of the smallest id; texts without words all stay.

    A row goes only for another whose text is in the same class: of unrelated texts
    under one id each stays.
    """
    return jaccard.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold less than 60 % of every benchmark item; null and empty texts, and repeated rows, stay."""
    return decontaminate.without_covered(docs, queries.table(spark, sf_dir, "benchmark"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same rows with pseudonyms, and n_chars, if there is one, counted anew; null texts stay null."""
    new = queries.with_pseudonyms(docs, "text")
    if "n_chars" not in docs.columns:
        return new
    return new.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each row its id, the ids of its text and whether they decode to it; other columns go.

    A null text has null ids and no tokens, an empty one an empty list.
    """
    return pieces.encoded(docs, public_tokenizers.path(queries.MODEL))


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", one_of_each_class),
    ("decontamination", drop_contaminated),
    ("personal data", replace_personal_data),
    ("encoding", encode),
]

# Scores, tilings and tokens have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
