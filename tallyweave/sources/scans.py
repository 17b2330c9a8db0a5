"""Scan parallelism."""

from pyspark.sql import DataFrame


def spread_small_scan(df: DataFrame) -> DataFrame:
    """Deal the rows of a scan with fewer splits than cores, for work heavy per row such as text.

    A scan at scale has many splits and is returned as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
