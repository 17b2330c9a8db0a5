"""Review, rating and basket views over the star-schema tables the queries run on."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.functions.text import words
from tallyweave.operators.skew import in_tasks, tasks_for
from tallyweave.sources.scans import spread_small_scan


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as reviews: their order gives the user and the date."""
    orders = table(spark, folder, "orders")
    documents = spread_small_scan(table(spark, folder, "documents").select("doc_id", "text"))
    return documents.join(orders, F.col("doc_id") == F.col("o_orderkey")).select(
        F.col("doc_id").alias("review_id"),
        F.col("o_custkey").alias("user_id"),
        (F.col("doc_id") % 200).alias("business_id"),
        (1 + F.col("doc_id") % 5).cast("double").alias("stars"),
        F.col("o_orderdate").alias("date"),
        "text",
    )


def review_events(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as reviews without text, of the customer as the business."""
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("review_id"),
        F.col("o_custkey").alias("business_id"),
        F.col("o_orderdate").alias("date"),
    )


def businesses(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as businesses with a state, some null and some blank."""
    customer = table(spark, folder, "customer")
    nation = table(spark, folder, "nation")
    last_digit = F.col("c_custkey") % 10
    state = F.when(last_digit == 0, F.lit(None)).when(last_digit == 1, F.lit(" ")).otherwise(F.col("n_name"))
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("business_id"), state.alias("state")
    )


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    lines, orders = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    tasks = tasks_for(spark, lines.count())
    lines, orders = in_tasks(lines, tasks, "l_orderkey"), in_tasks(orders, tasks, "o_orderkey")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def part_ratings(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as ratings of parts by customers, with repeats."""
    return order_lines(spark, folder).select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("business_id"),
        F.ceil(F.col("l_quantity") / 10).cast("double").alias("stars"),
        F.col("o_orderdate").alias("ts"),
        "l_orderkey",
        "l_linenumber",
    )


def yearly_ratings(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as (year, customer, supplier, rating) rows."""
    return order_lines(spark, folder).select(
        F.year("o_orderdate").alias("year"),
        F.col("o_custkey").alias("user_id"),
        F.col("l_suppkey").alias("business_id"),
        F.ceil(F.col("l_quantity") / 10).cast("int").alias("rating"),
    )


def brand_lines(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order line: the order and the brand bought."""
    return table(spark, folder, "lineitem").join(
        table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey")
    ).select(F.col("l_orderkey").alias("user_id"), F.col("p_brand").alias("business_id"))


def document_words(spark: SparkSession, folder: str) -> DataFrame:
    """Every document as the set of its words: distinct (user_id, element) rows."""
    return (
        spread_small_scan(table(spark, folder, "documents").select("doc_id", "text"))
        .select(F.col("doc_id").alias("user_id"), F.explode(words(F.col("text"))).alias("element"))
        .where(F.col("element") != "")
        .distinct()
    )
