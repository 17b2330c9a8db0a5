"""The six-part review report."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyweave.operators import exploration


def review_report(
    reviews: DataFrame,
    stopwords: DataFrame,
    year: int = 2015,
    longer_than: int = 3,
    months: int = 5,
    words: int = 10,
) -> DataFrame:
    """(metric, key, rank, value) rows.

    A average stars; B reviews not of ``year``; C top months; D cleaned words per month from ``year``
    on; E average cleaned length from ``year`` on; F top words from ``year`` on.  Only the top lists
    and the month totals are ranked, so the windows see at most a few rows.
    """

    def single(df: DataFrame, metric: str) -> DataFrame:
        return df.select(
            F.lit(metric).alias("metric"),
            F.lit(None).cast("string").alias("key"),
            F.lit(1).alias("rank"),
            F.col(df.columns[0]).cast("double").alias("value"),
        )

    def ranked(df: DataFrame, metric: str, key: str, value: str, *order: Column) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(F.lit(metric)).orderBy(*order))
        return df.select(
            F.lit(metric).alias("metric"),
            F.col(key).alias("key"),
            place.alias("rank"),
            F.col(value).cast("double").alias("value"),
        )

    latest_first = F.col("month").try_cast("int").desc()
    parts = [
        single(exploration.average_stars(reviews), "A"),
        single(exploration.count_other_years(reviews, year), "B"),
        ranked(exploration.top_months(reviews, months), "C", "month", "reviews", F.desc("reviews"), latest_first),
        ranked(exploration.words_per_month(reviews, year, stopwords), "D", "month", "words", F.col("month")),
        single(exploration.average_review_length(reviews, year, stopwords), "E"),
        ranked(
            exploration.top_words(reviews, year, stopwords, longer_than, words), "F", "word", "n", F.desc("n"), F.col("word")
        ),
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report
