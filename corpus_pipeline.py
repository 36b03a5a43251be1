"""Corpus pipeline: language, near copies, benchmark leaks, mixture, shards.

``STAGES`` holds ``(name, function)``; each function takes ``(spark, docs,
sf_dir)`` and returns the documents that it leaves, with the columns of
``documents``; the last adds each row's ``shard`` and ``slot``.  ``run`` writes
every stage's result to the shared folder and reads it for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm import decontaminate, language, mixing, sharding, simhash
from quillspark.llm.common import staged
from quillspark.session import read_table

SHARDS = 40

#: Least posterior of the predicted language.
LEAST_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; learned as in the query, from two thirds of the ids."""
    training = docs.where(language.fold("doc_id", 3) != 1)
    found = language.identify(docs, training, out="_language")
    return found.where((F.col("_language.lang") != language.UNKNOWN) & (F.col("_language.score") >= LEAST_SCORE)).select(
        docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.deduplicate(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them; the copy at a source's cut is shortened."""
    return mixing.repeat_rows(mixing.mix(docs))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard (0 to 39) and slot."""
    return sharding.stratified_shards(docs, SHARDS)


STAGES = [
    ("language", language_id),
    ("near_copies", near_copies),
    ("benchmark", benchmark_leaks),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: SQL can express neither language ID nor the fingerprints; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
