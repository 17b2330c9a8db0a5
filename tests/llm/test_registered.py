"""Registered queries against their SQL twins, and the pipeline against its stages."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyweave.llm import decontamination, quality
from tallyweave.llm.registry import ORACLE_SQL, QUERIES
from tallyweave.storage import tables_written

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    result = QUERIES[name](spark, FOLDER)
    cursor = duck.execute(ORACLE_SQL[name])
    names = [column[0] for column in cursor.description]
    assert sorted(names) == sorted(result.columns)
    got = sorted((tuple(row) for row in result.select(*names).collect()), key=repr)
    assert got == sorted(cursor.fetchall(), key=repr)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "ngram_join", "decontamination", "source_mix"]
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = kept
        kept = stage(spark, before, FOLDER).cache()
        assert kept.schema.names == docs.schema.names
        assert kept.join(before, "doc_id", "left_anti").count() == 0
        assert kept.where(F.length("text") != F.col("n_chars")).count() == 0, name
    left = decontamination.contamination(kept, spark.read.parquet(f"{FOLDER}/benchmark.parquet"))
    assert left.where("contaminated").count() <= left.count() // 50  # only where a cut brings words together
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    scored = quality.quality_scores(docs, labels).where("predicted = 0")
    assert kept.join(scored, "doc_id").count() == 0
    mixed = corpus_pipeline.run(spark, FOLDER)
    assert mixed.columns == ["doc_id", "size", "source_size", "target", "taken"]
    assert sorted(r[0] for r in mixed.select("doc_id").collect()) == sorted(r[0] for r in kept.select("doc_id").collect())


def test_stage_results_outlive_later_stages(spark, monkeypatch):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    held = corpus_pipeline.dedup_lines(spark, docs, FOLDER)
    other = corpus_pipeline.dedup_lines(spark, docs.where("doc_id < 50"), FOLDER)
    assert held.count() > other.count() > 0
    monkeypatch.setattr(corpus_pipeline, "STAGES", [corpus_pipeline.STAGES[1], corpus_pipeline.STAGES[-1]])
    before = len(tables_written(spark))
    first = corpus_pipeline.run(spark, FOLDER)
    paths = tables_written(spark)[before:]
    end = next(i for i, path in enumerate(paths) if "/stage-line_dedup-" in path)
    assert end > 0 and not any(os.path.exists(path.removeprefix("file:")) for path in paths[:end])
    second = corpus_pipeline.run(spark, FOLDER)
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, second.collect()))
