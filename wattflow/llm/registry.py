"""Queries of the numbered operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from wattflow.llm import (bpe, chat, collocations, cover_tree, language_id, ngram_jaccard, oracle, packing,
                          periodic_runs, piece_bpe, quality_rules, repeats, sharding, toxicity)
from wattflow.llm.common import read_table

#: Files of public tokenizers; the same paths on every machine.
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_query(spark, read_table(spark, sf_dir, "conversations"), BYTE_BPE)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_query(read_table(spark, sf_dir, "documents"),
                                   read_table(spark, sf_dir, "labels"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_query(read_table(spark, sf_dir, "documents"))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.jaccard_components(read_table(spark, sf_dir, "documents"), n=3, percent=90)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(read_table(spark, sf_dir, "documents"), WORD_BPE)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_query(read_table(spark, sf_dir, "documents"))


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_duplicates(read_table(spark, sf_dir, "embeddings"), cosine=0.9)


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.remove_repeats(read_table(spark, sf_dir, "documents"), length=400, with_text=True, with_row=False)
    return cut.withColumnRenamed("kept_text", "text")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), BYTE_BPE)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_query(read_table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine_collocations(read_table(spark, sf_dir, "documents"))


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.pieces_query(read_table(spark, sf_dir, "documents"), PIECE_BPE)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.runs_query(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_chat_formatting, op2_toxicity, op3_sharding, op4_ngram_jaccard,
                            op5_bpe, op6_language_id, op7_embedding_near_dedup,
                            op8_suffix_array_dedup, op9_packing, op10_quality_rules,
                            op11_collocations, op12_sentencepiece, op13_periodic_runs)}
ORACLE: dict[str, str] = {"op11_collocations": oracle.collocations()}
