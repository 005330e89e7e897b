"""Corpus pipeline: quality rules, near duplicates, decontamination, mixing, token files.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``documents``. Each result is written as Parquet and read again by the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kickstar.llm import decontaminate, mixing, ngram_join, quality, queries
from kickstar.llm.common import stored, table
from kickstar.session import configure


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. Null and empty texts have no words and go; very long
    texts are judged whole; repeated rows are judged alike; an empty table gives no rows. Extra
    columns stay, whatever their names."""
    return quality.judge(docs).filter("kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id (null last; ties by
    text hash; one of fully repeated rows). Texts without words all stay; very long texts are
    compared whole; an empty table gives no rows. Extra columns stay, whatever their names."""
    return ngram_join.keep_one(docs).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark. Null and empty texts have no words and
    stay; very long texts are judged whole; repeated rows are judged alike; empty tables are
    fine. Extra columns stay, whatever their names."""
    judged = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark"))
    return judged.filter("not contaminated").select(*docs.columns)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to their source's target weight, in random order. A null source is a
    source; null and empty texts have size 0; rows that share an id are drawn by their texts, fully
    repeated rows alike; an empty table gives no rows. Extra columns stay, whatever their names."""
    return mixing.mix(docs).select(*docs.columns)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mixture, read back: doc_id, start, n_tokens, ids_crc32 per document. A null
    text is empty and has the end id only; null ids come first, equal ids in the order of their
    text hashes, each repeated row has a row; an empty table gives no rows; other columns are not read."""
    return queries.op8_token_files(spark, sf_dir, docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mixing", source_mixing),
    ("token_files", token_files),
]

#: No SQL: tokenization by a library is not expressible; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    configure(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
