"""A corpus from raw documents to token ids, stage by stage.

Every stage takes the documents that its predecessor kept (read back from Parquet) and decides on all of
them; all stages but the last return the columns of documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from casegauge.llm import decontaminate, exact_dedup, near_dedup, pieces, quality
from casegauge.llm.common import stored
from casegauge.sources.tables import read_parquet

ORACLE_SQL = None  # a fitted classifier and near-duplicate components are not for SQL; tests hold them against brute force


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of good quality that are not toxic. Null texts count as empty, null source and lang as sites of their own; repeated
    rows are judged one by one; columns beside those of documents pass through, whatever their names."""
    return quality.accepted(docs, read_parquet(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are equal but for white space, the one with the smallest doc_id (one row, if rows repeat)."""
    return exact_dedup.exact_dedup(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, similarity 0.75) the one with the smallest doc_id; documents
    without words, null texts among them, all stay, a null doc_id ranks behind all others, and of repeated rows with words one
    stays. Other columns pass through, whatever their names."""
    return near_dedup.near_dedup(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, repeated rows among them, with the occurrences of benchmark windows taken out of their texts (n_chars stays as
    it was, a null text stays null). Other columns pass through, whatever their names."""
    return decontaminate.without_spans(docs, read_parquet(spark, sf_dir, "benchmark"))


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of tokens, token ids with an end id, and whether decoding gives the text back, for every row, repeated ones
    too; a null text counts as empty. No rows give no rows."""
    out = pieces.encoded(docs, public_tokenizers.path("piece_bpe_32k.model"), carry=["doc_id", "text"])
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
                      (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("exact"))


STAGES = [("quality", quality_stage), ("exact", exact_stage), ("near", near_stage), ("benchmark", benchmark_stage), ("pieces", pieces_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_parquet(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
