"""The registered corpus queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from starloom import workspace
from starloom.llm import (
    chat,
    embeddings,
    jaccard,
    language,
    lexical_search,
    mixing,
    oracle,
    packing,
    quality,
    spelling,
    token_counts,
    token_files,
    toxicity,
    url_filters,
)
from starloom.llm.tokenizing import TokenizerFile

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _tokenizer(name: str) -> TokenizerFile:
    return TokenizerFile.read(public_tokenizers.path(name))


def op1_pack_sequences(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(_table(spark, folder, "documents"), _tokenizer("word_bpe_49k.json"))


def op2_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.joined(_table(spark, folder, "documents"), words=3, percent=90)


def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.language_report(_table(spark, folder, "documents"))


def op4_embedding_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_duplicates(_table(spark, folder, "embeddings"))


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_report(_table(spark, folder, "documents"), _tokenizer("byte_bpe_50k.json"))


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_report(_table(spark, folder, "documents"))


def op7_token_files(spark: SparkSession, folder: str) -> DataFrame:
    written = workspace.scratch(spark, "token-files")
    token_files.write(_table(spark, folder, "documents"), _tokenizer("byte_bpe_50k.json"), written)
    return token_files.read(spark, written)


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity_report(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op9_chat_examples(spark: SparkSession, folder: str) -> DataFrame:
    return chat.digests(chat.examples(chat.with_tricky(_table(spark, folder, "conversations"))))


def op10_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed(_table(spark, folder, "documents"))


def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical_search.ranked(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op12_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return url_filters.judged(_table(spark, folder, "pages"), url_filters.rule_table(spark))


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(_table(spark, folder, "documents"))


QUERIES: dict[str, Query] = {
    "op1_pack_sequences": op1_pack_sequences,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_language_id": op3_language_id,
    "op4_embedding_duplicates": op4_embedding_duplicates,
    "op5_token_counts": op5_token_counts,
    "op6_quality_rules": op6_quality_rules,
    "op7_token_files": op7_token_files,
    "op8_toxicity": op8_toxicity,
    "op9_chat_examples": op9_chat_examples,
    "op10_mix_sources": op10_mix_sources,
    "op11_lexical_search": op11_lexical_search,
    "op12_url_filters": op12_url_filters,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLE_SQL: dict[str, str] = {
    "op2_jaccard_join": oracle.JACCARD,
    "op4_embedding_duplicates": oracle.EMBEDDINGS,
    "op9_chat_examples": chat.SQL,
    "op10_mix_sources": mixing.SQL,
    "op11_lexical_search": lexical_search.SQL,
    "op12_url_filters": url_filters.SQL,
    "op13_spelling_variants": spelling.SQL,
}
