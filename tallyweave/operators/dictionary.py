"""A dense index that grows: values keep their numbers for good, new ones follow.

The index is a clustered table of (value, number).  Values are looked up by a join that does not move it,
and an extension appends the values it lacks, sorted, after the last number.  So signatures, bit maps and
models made with the numbers stay valid when data is added.

Defined cases: a null is no value; values already there, repeated values and an empty batch add nothing.
An extension numbers its own values in their order; the whole index is sorted only after a single one.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.operators.ranking import dense_index
from tallyweave.sources.model_tables import BUCKETS, append_clustered, read_clustered, write_clustered
from tallyweave.storage import written


def start(values: DataFrame, column: str, path: str, name: str = "idx", buckets: int = BUCKETS) -> DataFrame:
    """The sorted distinct values of ``column`` numbered from 0, stored under ``path``."""
    numbered = dense_index(values.where(F.col(column).isNotNull()), column, name)
    return write_clustered(numbered.select(column, name), path, [column], buckets)


def load(spark: SparkSession, path: str) -> DataFrame:
    return read_clustered(spark, path)


def extend(values: DataFrame, path: str) -> DataFrame:
    """Number the values that the index under ``path`` lacks; the index with them.

    Distinct values move to the index, which stays in place.  Numbers are offsets of range partitions, so
    no task sees all new values.  A batch added again after a failure adds nothing twice.
    """
    index = read_clustered(values.sparkSession, path)
    column, name = index.columns
    distinct = values.select(column).where(F.col(column).isNotNull()).distinct()
    fresh = written(distinct.join(index.select(column), column, "left_anti"), "new-values")
    if fresh.isEmpty():
        return index
    first = index.agg((F.coalesce(F.max(name), F.lit(-1)) + 1).alias("first")).first()["first"]
    numbered = dense_index(fresh, column, name).withColumn(name, F.col(name) + F.lit(first))
    return append_clustered(written(numbered, "new-numbers"), path)
