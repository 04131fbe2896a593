"""A training-data pipeline over ``documents``: each stage keeps what the next one reads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from public_tokenizers import path

from lisan.llm import exact_dedup, language, mixing, packing, simhash
from lisan.llm.common import written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language cannot be told, those without a letter, go."""
    return language.keep_known(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return exact_dedup.drop_exact(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.drop_near(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it, which may be never."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their place in sequences of 2048 tokens."""
    return packing.pack(docs, path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("language id", languages),
    ("exact dedup", exact),
    ("near dedup", near),
    ("mixing", mix),
    ("packing", pack),
]

#: The stages cannot be expressed in SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
