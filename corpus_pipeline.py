"""The training-data pipeline: five operators, each over all that its predecessor kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as
Parquet and read again as the next one's docs. All but the last return the
columns of documents.

Each stage handles nulls in any column, empty and long texts, repeated rows and
empty tables as its operator's docstring says. A document without a letter, or
whose language has less than half of the posterior, is rejected by the first
stage; of equal texts the largest doc_id stays; of near-duplicates the smallest
of its component; the mix repeats or drops documents to meet its targets.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackgrid.llm import exact, langid, mix, pack, simhash
from trackgrid.llm.ship import ship
from trackgrid.session import cut

LEAST_SHARE = 0.5
SHINGLE, SIMILARITY = 5, 0.8


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; learns from all that have a label."""
    ship(spark)
    model = langid.fit(docs, public_tokenizers.path("piece_bpe_32k.model"), F.lit(True))
    found = langid.predict(docs, model)
    return found.filter((F.col("__lang") != "und") & (F.col("__score") >= LEAST_SHARE)).select(*docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each normalised text."""
    return exact.keep_one(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    ship(spark)
    return simhash.keep_one(docs, SHINGLE, SIMILARITY)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: a row for each time a document is taken."""
    ship(spark)
    return mix.mixed(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their ids and their place in a window of 2048."""
    ship(spark)
    p = public_tokenizers
    return pack.pack(docs, p.path("byte_bpe_50k.json"), p.path("byte_bpe_50k.tiktoken"), p.PATTERN)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("pack_windows", pack_windows),
]

#: SQL can express neither the first stage nor those after it; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
