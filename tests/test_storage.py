"""Intermediate tables: kept while they are read, deleted one by one or all together."""

import os

import pytest
from pyspark.errors import AnalysisException

from tallyweave import storage


def _folders(spark):
    folder = f"{storage.shared_folder(spark)}/tallyweave/{spark.sparkContext.applicationId}".removeprefix("file:")
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def test_tables_are_deleted_singly(spark):
    before = _folders(spark)
    first = storage.written(spark.range(10).toDF("a"), "first")
    second = storage.written(first.selectExpr("a * 2 AS b"), "second")
    assert len(_folders(spark) - before) == 2
    storage.forget(first)
    assert second.count() == 10 and len(_folders(spark) - before) == 1
    with pytest.raises(Exception):
        first.count()
    mine = [p for p in storage.tables_written(spark) if "/second-" in p][-1:]
    storage.delete_tables(spark, mine)
    assert _folders(spark) == before
    with pytest.raises(AnalysisException):
        spark.read.parquet(mine[0])
