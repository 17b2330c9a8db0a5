"""Baskets in long form: distinct (basket, item) rows with text items."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _long_form(rows: DataFrame, basket: str, item: str) -> DataFrame:
    return rows.select(
        F.col(basket).alias("basket"), F.col(item).cast("string").alias("item")
    ).distinct()


def year_baskets(ratings: DataFrame, year: int, case: int = 1, over_rating: int = 0) -> DataFrame:
    """Baskets of one year: businesses per user (case 1), otherwise users per business.

    ``over_rating`` keeps ratings above it; 0 keeps every rating.
    """
    kept = ratings.where(F.col("year") == year)
    if over_rating != 0:
        kept = kept.where(F.col("rating") > over_rating)
    if case == 1:
        return _long_form(kept, "user_id", "business_id")
    return _long_form(kept, "business_id", "user_id")


def user_baskets(user_business: DataFrame, more_than: int) -> DataFrame:
    """Businesses per user, for users with more distinct businesses than the threshold."""
    baskets = _long_form(user_business, "user_id", "business_id")
    sizes = baskets.groupBy("basket").agg(F.count(F.lit(1)).alias("n"))
    large = sizes.where(F.col("n") > more_than).select("basket")
    return baskets.join(large, "basket", "left_semi")


def in_shards(baskets: DataFrame, shards: int) -> DataFrame:
    """Deal whole baskets to shards by a hash of the basket."""
    return baskets.withColumn("shard", F.pmod(F.xxhash64("basket"), F.lit(shards)).cast("int"))


def item_support(baskets: DataFrame) -> DataFrame:
    """Number of baskets that hold each item."""
    return baskets.groupBy("item").agg(F.count(F.lit(1)).alias("support"))
