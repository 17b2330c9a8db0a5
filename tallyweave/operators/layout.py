"""How review rows are laid out over partitions: the scan's own layout and one keyed by year."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.functions.dates import year_number


def _all_partitions(counts: DataFrame, n_partitions: int) -> DataFrame:
    """Counts for the partitions 0 .. n-1, with 0 for those that hold no row."""
    numbers = counts.sparkSession.range(n_partitions).select(F.col("id").cast("int").alias("partition"))
    return numbers.join(counts, "partition", "left").select("partition", F.coalesce("items", F.lit(0)).alias("items"))


def _counts(df: DataFrame) -> DataFrame:
    """(partition, items) of the partitions that hold rows.

    The hash keeps every column in the plan: a pruned frame could be laid out in another way.
    """
    tagged = df.select(F.spark_partition_id().alias("partition"), F.xxhash64(*df.columns).alias("row"))
    return tagged.groupBy("partition").agg(F.count(F.lit(1)).alias("items"), F.bit_xor("row")).select("partition", "items")


def partition_profile(df: DataFrame) -> DataFrame:
    """(partition, items) of a frame as its plan lays it out."""
    return _all_partitions(_counts(df), df.rdd.getNumPartitions())


def _target(reviews: DataFrame, n_partitions: int) -> Column:
    """``year mod n``; reviews without a readable year go to partition 0."""
    return F.coalesce(F.pmod(year_number(reviews), F.lit(n_partitions)), F.lit(0)).cast("int")


def lay_out_by_year(reviews: DataFrame, n_partitions: int) -> DataFrame:
    """Move every review to partition ``year mod n``, or 0 where it has no year."""
    return reviews.repartitionById(n_partitions, _target(reviews, n_partitions))


def keyed_partition_profile(reviews: DataFrame, n_partitions: int) -> DataFrame:
    """(partition, items) of the reviews as :func:`lay_out_by_year` has moved them."""
    return _all_partitions(_counts(lay_out_by_year(reviews, n_partitions)), n_partitions)


def year_partition_profile(reviews: DataFrame, n_partitions: int) -> DataFrame:
    """As :func:`keyed_partition_profile`, counted without moving the rows.

    The partition is a function of the row, so partial counts suffice and the rows of a dominant
    year never have to meet in one task.
    """
    counts = reviews.groupBy(_target(reviews, n_partitions).alias("partition")).agg(F.count(F.lit(1)).alias("items"))
    return _all_partitions(counts, n_partitions)
