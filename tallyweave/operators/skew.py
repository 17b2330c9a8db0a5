"""Pairing, joining and grouping that keep any one key, or too many rows, from landing in one task."""

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.storage import written

# Rows of one key that a single join cell may hold on one side.
CELL_ROWS = 4096
TASK_ROWS = 1_000_000  # rows that one task sorts or groups, on average


def tasks_for(spark: SparkSession, rows: int) -> int | None:
    """Partitions of ``TASK_ROWS`` rows, or None where the session's own number of them gives fewer rows each."""
    tasks = math.ceil(rows / TASK_ROWS)
    return tasks if tasks > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def in_tasks(rows: DataFrame, tasks: int | None, *keys: str) -> DataFrame:
    """``rows`` with equal ``keys`` together in the given number of partitions; as they are for None."""
    return rows if tasks is None else rows.repartition(tasks, *keys)


def _equal(left: str, right: str, names: Sequence[str]) -> Column:
    condition = F.lit(True)
    for name in names:
        condition = condition & (F.col(f"{left}.{name}") == F.col(f"{right}.{name}"))
    return condition


def _ordered(name: str, carry: Sequence[str]) -> list[Column]:
    """Both sides of a pair with the smaller id first: name_1, name_2 and the carried columns alike."""
    forward = F.col(f"l.{name}") < F.col(f"r.{name}")
    columns = []
    for column in (name, *carry):
        left, right = F.col(f"l.{column}"), F.col(f"r.{column}")
        columns.append(F.when(forward, left).otherwise(right).alias(f"{column}_1"))
        columns.append(F.when(forward, right).otherwise(left).alias(f"{column}_2"))
    return columns


def big_groups(rows: DataFrame, keys: Sequence[str], cell_rows: int = CELL_ROWS) -> DataFrame:
    """Keys holding more than ``cell_rows`` rows, with the number of cells to cut each into."""
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_of_key"))
    return sizes.where(F.col("rows_of_key") > cell_rows).select(
        *keys, F.ceil(F.col("rows_of_key") / cell_rows).cast("int").alias("cells")
    )


def pairs_in_groups(
    rows: DataFrame,
    keys: Sequence[str],
    name: str,
    carry: Sequence[str] = (),
    keep: Column | None = None,
    cell_rows: int = CELL_ROWS,
    big: DataFrame | None = None,
) -> DataFrame:
    """Unordered pairs of different ``name`` values that share all ``keys``.

    ``rows`` must be distinct in (keys, name).  Gives the keys, ``name_1 < name_2`` and the carried
    columns of both sides.  ``keep`` is a further condition on the aliases l and r, symmetric in
    them.  An ordinary group is one equi-join on the keys.  A group above ``cell_rows`` is cut into
    blocks by a hash of the id and joined block against block, so its pairs spread over
    cells*(cells+1)/2 join keys and no task receives the group.  ``big`` gives
    :func:`big_groups` where the caller has the sizes already.
    """
    keep = F.lit(True) if keep is None else keep
    if big is None:
        big = written(big_groups(rows, keys, cell_rows), "big-groups")
    output = [F.col(f"l.{key}").alias(key) for key in keys]

    def plain(part: DataFrame) -> DataFrame:
        l, r = part.alias("l"), part.alias("r")
        rising = F.col(f"l.{name}") < F.col(f"r.{name}")
        sides = [
            F.col(f"{side}.{column}").alias(f"{column}_{number}")
            for column in (name, *carry)
            for side, number in (("l", 1), ("r", 2))
        ]
        return l.join(r, _equal("l", "r", keys) & rising & keep).select(*output, *sides)

    if big.isEmpty():
        return plain(rows)

    block = F.pmod(F.xxhash64(name), F.col("cells")).cast("int")
    blocked = rows.join(big, list(keys)).withColumn("block", block)
    lefts = blocked.withColumn("column_cell", F.explode(F.sequence("block", F.col("cells") - 1)))
    rights = blocked.withColumn("row_cell", F.explode(F.sequence(F.lit(0), "block")))
    l = lefts.withColumnRenamed("block", "row_cell").alias("l")
    r = rights.withColumnRenamed("block", "column_cell").alias("r")
    once = (F.col("l.row_cell") < F.col("l.column_cell")) | (F.col(f"l.{name}") < F.col(f"r.{name}"))
    crossed = l.join(r, _equal("l", "r", [*keys, "row_cell", "column_cell"]) & once & keep).select(
        *output, *_ordered(name, carry)
    )
    return plain(rows.join(big, list(keys), "left_anti")).unionByName(crossed)


def spread_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], cell_rows: int = CELL_ROWS
) -> DataFrame:
    """Inner equi-join in which both sides may hold many rows of the same key.

    Rows of a key with more than ``cell_rows`` rows on the left are dealt to cells by a hash of the
    whole row, and the right side repeats that key once a cell.  Other keys join as they are, so a
    right side clustered by ``keys`` moves the rows of such keys only.
    """
    big = written(big_groups(left, keys, cell_rows), "big-keys")
    if big.isEmpty():
        return left.join(right, list(keys))
    keys = list(keys)
    dealt = left.join(big, keys).withColumn("cell", F.pmod(F.xxhash64(*left.columns), "cells").cast("int"))
    repeated = right.join(big, keys).withColumn("cell", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
    spread = dealt.drop("cells").join(repeated.drop("cells"), [*keys, "cell"]).drop("cell")
    return left.join(big, keys, "left_anti").join(right, keys).unionByName(spread)
