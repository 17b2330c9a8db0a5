"""Precision and recall of found pairs, and error of predicted ratings."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def precision_recall(found: DataFrame, truth: DataFrame, keys: list[str], weight: str | None = None) -> DataFrame:
    """(hits, found, truth, precision, recall) of two sets of distinct keys.

    ``weight`` names a column saying how many rows a key stands for.
    """
    def counted(df: DataFrame, flag: str) -> DataFrame:
        size = F.lit(1).cast("bigint") if weight is None else F.col(weight)
        here = {"found": F.lit(0), "truth": F.lit(0)}
        here[flag] = F.lit(1)
        return df.select(*keys, size.alias("size"), *[mark.alias(name) for name, mark in here.items()])

    both = counted(found, "found").unionByName(counted(truth, "truth"))
    per_key = both.groupBy(*keys).agg(F.max("size").alias("size"), F.max("found").alias("f"), F.max("truth").alias("t"))

    def total(condition):
        return F.coalesce(F.sum(F.when(condition, F.col("size"))), F.lit(0))

    return per_key.agg(
        total((F.col("f") == 1) & (F.col("t") == 1)).alias("hits"),
        total(F.col("f") == 1).alias("found"),
        total(F.col("t") == 1).alias("truth"),
    ).select("*", *_ratios())


def _ratios() -> list[Column]:
    hits = F.col("hits").cast("double")
    return [F.try_divide(hits, F.col("found")).alias("precision"), F.try_divide(hits, F.col("truth")).alias("recall")]


def precision_recall_of_counts(counted: DataFrame) -> DataFrame:
    """As :func:`precision_recall`, from rows (weight, found, similar, hit) that need no key to be told apart.

    The flags say in which of the three counts the ``weight`` of a row belongs; nothing but sums is shuffled.
    """

    def total(flag: str):
        return F.coalesce(F.sum(F.when(F.col(flag), F.col("weight"))), F.lit(0))

    totals = counted.agg(total("hit").alias("hits"), total("found").alias("found"), total("similar").alias("truth"))
    return totals.select("*", *_ratios())


def rmse(predictions: DataFrame, truth: DataFrame) -> DataFrame:
    """(pairs, rmse) of predicted against actual stars; both hold one row per user and business."""
    joined = predictions.select("user_id", "business_id", F.col("stars").alias("predicted")).join(
        truth.select("user_id", "business_id", "stars"), ["user_id", "business_id"]
    )
    error = F.col("predicted") - F.col("stars")
    return joined.agg(F.count(F.lit(1)).alias("pairs"), F.sqrt(F.avg(error * error)).alias("rmse"))
