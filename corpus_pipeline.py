"""A corpus pipeline over ``documents``: quality, line dedup, near duplicates, benchmark passages, mix.

Every stage takes (spark, docs, sf_dir) and returns what it keeps; it is written and read again before
the next.  The last returns the mix: doc_id, size, source_size, target and taken of every document left.
A stage called by itself leaves its intermediate tables, since its result may still read them; ``run``
deletes those of a stage whose output it has written.
Near duplicates are documents whose five-word shingles have a Jaccard similarity of 0.8 and more.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyweave.llm import decontamination, line_dedup, mixing, ngram_join, quality
from tallyweave.storage import delete_tables, tables_written, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

SHINGLE = 5
SIMILAR = (80, 100)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labels of those still here, does not reject."""
    return quality.keep_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that stand, up to one edit, earlier in the corpus."""
    return line_dedup.dedup_lines(docs)


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones."""
    return ngram_join.keep_one(docs, SHINGLE, SIMILAR)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of the benchmark."""
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix of sources takes."""
    return mixing.mix(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_quality),
    ("line_dedup", dedup_lines),
    ("ngram_join", keep_one),
    ("decontamination", decontaminate),
    ("source_mix", mix_sources),
]
ORACLE_SQL = None  # a fitted classifier is not SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        before = len(tables_written(spark))
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
        delete_tables(spark, tables_written(spark)[before:-1])
    return STAGES[-1][1](spark, docs, sf_dir)
