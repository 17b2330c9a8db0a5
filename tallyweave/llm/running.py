"""Running totals over a distributed order, without one task holding a whole key."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.storage import written


def running_total(
    rows: DataFrame, key: str, order: Sequence[str], value: str, name: str, label: str = "running"
) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows before this one, of the same ``key``, in ``order``.

    Rows are range partitioned by key and order and written, which fixes the piece of each row.  A
    piece holds a bounded share of a key however large that key is; only one total a piece and key
    passes through the window that shifts the pieces.  Equal rows get places of their own.  ``key``
    must not be null.
    """
    pieces = rows.repartitionByRange(key, *order).withColumn("piece", F.spark_partition_id())
    pieces = written(pieces, label)
    before = [Window.unboundedPreceding, -1]
    within = Window.partitionBy(key, "piece").orderBy(*order).rowsBetween(*before)
    over = Window.partitionBy(key).orderBy("piece").rowsBetween(*before)
    zero = F.lit(0).cast("bigint")
    totals = pieces.groupBy(key, "piece").agg(F.sum(value).alias("piece_total"))
    shifts = totals.select(key, "piece", F.coalesce(F.sum("piece_total").over(over), zero).alias("shift"))
    return (
        pieces.withColumn(name, F.coalesce(F.sum(value).over(within), zero))
        .join(shifts, [key, "piece"])
        .withColumn(name, F.col(name) + F.col("shift"))
        .drop("piece", "shift")
    )
