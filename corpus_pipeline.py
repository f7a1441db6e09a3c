"""A training-corpus pipeline of stages, each written as Parquet and read by the next."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from railpulse.llm import toxicity
from railpulse.llm.decontaminate import decontaminated
from railpulse.llm.mixing import mixed
from railpulse.llm.queries import TOKENIZER, importable, table
from railpulse.llm.simhash import deduplicated
from railpulse.llm.tokens import encoded
from railpulse.sinks.tables import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Words of a shingle, and bits in which fingerprints of near copies may differ.
SHINGLE_WORDS, BITS_APART = 4, 4


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject."""
    importable(spark)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    importable(spark)
    return deduplicated(docs, shingle=SHINGLE_WORDS, threshold=BITS_APART)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    importable(spark)
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    importable(spark)
    return mixed(docs)


def token_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document's ids in the written shards."""
    importable(spark)
    return encoded(docs, public_tokenizers.path(TOKENIZER))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark),
    ("mixing", mix_sources),
    ("token_shards", token_shards),
]

#: SQL has no classifier, SimHash or tokenizer; tests hold each stage against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the whole table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
