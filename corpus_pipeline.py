"""Corpus pipeline: from raw documents to indexed token shards.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's ``docs``. All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulary.llm import decontaminate, language_id, mixing, near_dup
from tabulary.llm.common import materialize, table
from tabulary.llm.queries import token_rows


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a text in a learned language; null texts and those without letters go."""
    return language_id.keep_languages(docs, language_id.fit(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each near-duplicate group."""
    return near_dup.drop_near_duplicates(docs, width=5)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their sources' weights ask for, at most three times each."""
    return mixing.apply_mix(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The records of the token store: a row for each copy of a document."""
    return token_rows(docs)


STAGES = [
    ("language_id", identify_language),
    ("near_dup", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("mixing", mix_sources),
    ("token_store", write_tokens),
]

#: SQL can't express the stages; tests hold them against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
