"""A training corpus from raw documents: stages that hand on documents, the last one token ids."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, exact_dedup, mixing, near_dedup, toxicity
from tidemark.llm.common import Scratch, read
from tidemark.session import fresh_folder

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network, trained on the labelled ones among them, does not reject."""
    return toxicity.drop_toxic(docs, read(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles, similarity 0.8 or more."""
    return near_dedup.near_dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it."""
    return mixing.mix(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, token_ids`` of every document that the mix holds."""
    return bpe.encode(docs, bpe.share_ranks(spark, VOCABULARY, public_tokenizers.PATTERN))


_SCRATCH: dict[str, Scratch] = {}       # of the stages below, by application


def _tidy(stage: Stage) -> Stage:
    """The stage, after what earlier ones left in the shared folder has been deleted."""
    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with _SCRATCH.setdefault(spark.sparkContext.applicationId, Scratch()).stage(docs):
            return stage(spark, docs, sf_dir)

    return run_stage


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", _tidy(drop_toxic)),
    ("exact_dedup", _tidy(drop_copies)),
    ("minhash_near_dedup", _tidy(drop_near_copies)),
    ("mixing", _tidy(mix_sources)),
    ("byte_bpe", _tidy(tokenise)),
]

# a trained network decides which documents go on, which SQL cannot express
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written and read again as the next one's input."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        folder = fresh_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
