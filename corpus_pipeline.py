"""A corpus from documents to packed training sequences, stage by stage.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next one's ``docs``; all but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattflow.llm import language_id, ngram_jaccard, packing, repeats, toxicity
from wattflow.llm.common import prepare, read_table
from wattflow.llm.registry import BYTE_BPE
from wattflow.session import stage

#: Near duplicates: five-word shingles, similarity of 0.8 or more.
SHINGLE_WORDS, SIMILARITY_PERCENT = 5, 80
#: Bytes from which a repeated passage is cut. Most passages of 50 words are
#: longer; one of short words can be shorter and then stays.
REPEAT_BYTES = 250
#: Language predictions below this score are rejected as unknown.
LEAST_LANGUAGE_SCORE = 0.35


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter and those whose language stays unclear."""
    prepare(spark)
    seen = language_id.predict_language(docs, language_id.train(docs), with_row=True)
    kept = seen.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_LANGUAGE_SCORE))
    return kept.select("row_in.*")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the clause grammar predicts to be toxic."""
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    seen = toxicity.score_toxicity(docs, model, with_row=True)
    return seen.where("predicted = 0").select("row_in.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that of the smallest
    id; rows without an id are not grouped."""
    prepare(spark)
    groups = ngram_jaccard.jaccard_components(docs, SHINGLE_WORDS, SIMILARITY_PERCENT)
    stays = groups.where("doc_id = component_id").select("doc_id").distinct()
    kept = docs.join(stays, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.unionByName(docs.where("doc_id is null"))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages that repeat inside or across documents; every row stays."""
    prepare(spark)
    cut = repeats.remove_repeats(docs, REPEAT_BYTES, with_text=True)
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return cut.select(*[new.get(c, F.col(f"row_in.`{c}`")).alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of 1024 tokens; one row per piece."""
    prepare(spark)
    return packing.pack_documents(docs, BYTE_BPE, capacity=1024)


STAGES = [
    ("language_id", identify_language),
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeats),
    ("packing", pack),
]

#: The trained stages cannot be expressed in SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
