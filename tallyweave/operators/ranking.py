"""Global positions without sorting everything in one task."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.storage import written

_ROW_BITS = 33  # monotonically_increasing_id keeps the partition above the low 33 bits


def global_position(rows: DataFrame, order: Sequence[str], name: str = "position") -> DataFrame:
    """Number the rows 0, 1, 2, ... in ascending ``order``; rows equal in it follow in any order.

    Rows are range partitioned and sorted in their partition; the sorted table is written, which
    fixes the partition of every row, and each partition's rows are shifted by the count of rows in
    the partitions before it.  Only those counts, one a partition, pass through a single window.
    """
    numbered = (
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("mark", F.monotonically_increasing_id())
    )
    numbered = written(numbered, "positions")
    piece = F.shiftright("mark", _ROW_BITS).cast("int").alias("piece")
    before = Window.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        numbered.groupBy(piece)
        .agg(F.count(F.lit(1)).alias("n"))
        .select("piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    )
    in_piece = F.col("mark").bitwiseAND(F.lit(2**_ROW_BITS - 1))
    return (
        numbered.withColumn("piece", piece)
        .join(F.broadcast(offsets), "piece")  # one row a partition
        .withColumn(name, F.col("offset") + in_piece)
        .drop("piece", "offset", "mark")
    )


def dense_index(values: DataFrame, column: str, name: str = "idx") -> DataFrame:
    """The sorted distinct values of a column with their 0-based index."""
    return global_position(values.select(column).distinct(), [column], name)
