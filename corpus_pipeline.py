"""From raw documents to training sequences; each stage works on what the one before kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from starloom import workspace
from starloom.llm import jaccard, language, mixing, packing, toxicity
from starloom.llm.texts import BATCH_ROWS
from starloom.llm.tokenizing import TokenizerFile

# The executors' memory is used by then, so the tokenizer's workers hold less than they might.
CACHED_PIECES = 20_000
SLICE_BYTES = 1 << 20

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without a determined language go."""
    return language.with_known_language(docs)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity: documents that the classifier calls toxic go."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join on shingles of five words: one document of each group stays."""
    return jaccard.one_of_each(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: documents as often as the target weights of their sources ask for."""
    return mixing.repeated(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: the pieces of all documents with their places in the training sequences."""
    tokenizer = TokenizerFile.read(public_tokenizers.path("word_bpe_49k.json"))
    return packing.packed(docs, tokenizer, cached=CACHED_PIECES, slice_bytes=SLICE_BYTES)


def _in_small_batches(stage: Stage) -> Stage:
    """The stage in a session that sends Python workers a few megabytes of text at a time.

    The setting stays: it is read when the caller writes what the stage returns.
    """

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES: list[tuple[str, Stage]] = [
    ("language_id", _in_small_batches(known_language)),
    ("toxicity", _in_small_batches(not_toxic)),
    ("jaccard_join", _in_small_batches(one_of_each)),
    ("mixing", _in_small_batches(mixed)),
    ("packing", _in_small_batches(packed)),
]

# Language models, trained classifiers and tokenizers have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each stage's rows written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        folder = workspace.scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
