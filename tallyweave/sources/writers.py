"""Writers for reports and models.  Rows are written by the executors as JSON lines or parquet."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Any result as JSON lines: pairs, scores, predictions, edges, itemsets."""
    df.write.mode(mode).json(path)


def write_pairs(pairs: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Pairs (u1, u2, ...) as JSON lines in their order, within each part and from part to part."""
    pairs.orderBy("u1", "u2").write.mode(mode).json(path)


def write_review_report(report: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The long-form review report as one JSON object with the keys A to F.

    Collecting the rows into one object is safe here only because the report is: three scalars, at
    most n months, one entry a calendar month, and i words.
    """

    def scalar(key):
        return F.max(F.when(F.col("metric") == key, F.col("value")))

    def in_rank_order(key):
        rows = F.collect_list(F.when(F.col("metric") == key, F.struct("rank", "key", "value")))
        return F.array_sort(rows)

    def counted(name):
        return F.transform(
            name, lambda row: F.array(row["key"].cast("variant"), row["value"].cast("bigint").cast("variant"))
        )

    one = report.agg(
        scalar("A").alias("A"),
        scalar("B").cast("bigint").alias("B"),
        in_rank_order("C").alias("C"),
        in_rank_order("D").alias("D"),
        scalar("E").alias("E"),
        in_rank_order("F").alias("F"),
    )
    words = F.transform("F", lambda row: row["key"])
    body = F.struct("A", "B", counted("C").alias("C"), counted("D").alias("D"), "E", words.alias("F"))
    one.select(F.to_json(body, {"ignoreNullFields": "false"}).alias("value")).write.mode(mode).text(path)


def _labelled(label: str, count: str, *order: Column) -> Column:
    """The rows as [[label, count], ...] in the given order."""
    rows = F.array_sort(F.collect_list(F.struct(*order, F.col(label).alias("label"), F.col(count).alias("count"))))
    return F.transform(rows, lambda row: F.array(row["label"].cast("variant"), row["count"].cast("variant")))


def write_top_states(states: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """``{"result": [[state, count], ...]}``; the list is as long as the top list asked for."""
    result = states.agg(_labelled("state", "reviews", -F.col("reviews"), F.col("state")).alias("result"))
    result.select(F.to_json(F.struct("result")).alias("value")).write.mode(mode).text(path)


def write_partition_report(profile: DataFrame, years: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """``{"n_partitions": .., "n_items": [..], "result": [[year, count], ...]}``.

    The lists hold one entry a partition and one a year.
    """
    items = F.transform(F.array_sort(F.collect_list(F.struct("partition", "items"))), lambda row: row["items"])
    result = years.agg(_labelled("year", "reviews", F.col("year")).alias("result"))
    one = profile.agg(F.count(F.lit(1)).alias("n_partitions"), items.alias("n_items"))
    body = F.struct("n_partitions", "n_items", result.scalar().alias("result"))
    one.select(F.to_json(body).alias("value")).write.mode(mode).text(path)


def write_itemset_report(
    candidates: DataFrame,
    size_counts: DataFrame,
    frequent: DataFrame,
    path: str,
    numeric_items: bool = False,
    mode: str = "errorifexists",
) -> None:
    """Candidates, their counts by size, and frequent itemsets with support, each in its own folder.

    Itemsets are rows, sorted by size and items, because a single nested object would have to pass
    through one task.  With ``numeric_items`` candidates are ordered by their items as numbers, and
    the items inside a frequent itemset are.
    """
    order = F.col("items")
    if numeric_items:
        order = F.transform("items", lambda item: item.cast("bigint"))
        numbered = F.transform("items", lambda item: F.struct(item.cast("bigint").alias("number"), item.alias("item")))
        frequent = frequent.withColumn("items", F.array_sort(numbered)["item"])
    candidates.orderBy("size", order).write.mode(mode).json(f"{path}/candidates")
    size_counts.orderBy("size").write.mode(mode).json(f"{path}/num_candidates_by_size")
    total = size_counts.agg(F.coalesce(F.sum("itemsets"), F.lit(0)).alias("itemsets"))
    total.write.mode(mode).json(f"{path}/num_candidates")
    frequent.orderBy("size", "items").write.mode(mode).json(f"{path}/frequent_itemsets")


def write_profiles(items: DataFrame, users: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Content model as tagged JSON lines, item rows and user rows together."""
    item_lines = items.select(F.to_json(F.struct(F.col("business_id").alias("business"), "profile")).alias("value"))
    user_lines = users.select(F.to_json(F.struct(F.col("user_id").alias("user"), "profile")).alias("value"))
    item_lines.unionByName(user_lines).write.mode(mode).text(path)
