"""From raw documents to token ids: five stages, each written before the next reads it.

A stage takes ``(spark, docs, sf_dir)`` and works on all its predecessor kept.
The first four return the columns of ``documents``; the last adds the ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starkeel.llm import bpe, decontaminate, language_id, minhash_dedup, toxicity
from starkeel.llm.queries import TOXIC, tokenizer_path
from starkeel.llm.staging import Workspace

# Share of a text's n-grams that its language must hold for the text to stay.
LEAST_LANGUAGE_SHARE = 0.1


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold; learned from all labels."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.below(docs, model, TOXIC)


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told: without letters or language they go."""
    return language_id.identified(docs, language_id.fit(docs), LEAST_LANGUAGE_SHARE)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return minhash_dedup.one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the texts that stayed, and digests of ids and decoded texts."""
    return bpe.encode_decode(docs, tokenizer_path()).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        "ids",
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", keep_identified),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("bpe", encode),
]

# Classifiers, an LSH forest and BPE are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is stored and read again."""
    work = Workspace(spark, "corpus-pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = work.write(stage(spark, docs, sf_dir), name)
        work.keep(name)  # nothing reads the stage before any more
    return docs
