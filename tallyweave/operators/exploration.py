"""Averages, counts and top lists over reviews."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.functions.dates import month_text, year_number, year_text
from tallyweave.functions.text import NOT_WHITE_SPACE, strip_edges, words


def average_stars(reviews: DataFrame) -> DataFrame:
    return reviews.agg(F.avg("stars").alias("avg_stars"))


def count_other_years(reviews: DataFrame, year: int) -> DataFrame:
    """Number of reviews not of the given year."""
    other = ~year_text(reviews).eqNullSafe(F.lit(str(year)))
    return reviews.agg(F.count_if(other).alias("reviews"))


def top_months(reviews: DataFrame, n: int = 5) -> DataFrame:
    """The n calendar months with most reviews, the later month first on a tie."""
    counts = reviews.groupBy(month_text(reviews).alias("month")).agg(F.count(F.lit(1)).alias("reviews"))
    return counts.orderBy(F.desc("reviews"), F.col("month").try_cast("int").desc()).limit(n)


def month_word_counts(reviews: DataFrame, from_year: int, stopwords: DataFrame) -> DataFrame:
    """(month, word, n) of cleaned words in reviews from the given year on.

    Words are counted before the stopword join, so the join sees a vocabulary and not a corpus, and
    a very common word is one row by then.
    """
    tokens = reviews.where(year_number(reviews) >= from_year).select(
        month_text(reviews).alias("month"), F.explode(words(F.col("text"))).alias("token")
    )
    counts = (
        tokens.select("month", strip_edges(F.col("token")).alias("word"))
        .where(F.col("word") != "")
        .groupBy("month", "word")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counts.join(stopwords.select("word"), "word", "left_anti").select("month", "word", "n")


def words_per_month(reviews: DataFrame, from_year: int, stopwords: DataFrame) -> DataFrame:
    """Cleaned words per month; a month whose reviews hold none is kept with 0."""
    months = reviews.where(year_number(reviews) >= from_year).select(month_text(reviews).alias("month")).distinct()
    totals = (
        month_word_counts(reviews, from_year, stopwords).groupBy("month").agg(F.sum("n").alias("n"))
    )
    return (
        months.join(totals, months["month"].eqNullSafe(totals["month"]), "left")
        .select(months["month"], F.coalesce("n", F.lit(0)).alias("words"))
        .orderBy("month")
    )


def average_review_length(reviews: DataFrame, from_year: int, stopwords: DataFrame) -> DataFrame:
    """Cleaned words per review; null where no review is in range."""
    total = month_word_counts(reviews, from_year, stopwords).agg(F.sum("n").alias("words"))
    count = reviews.where(year_number(reviews) >= from_year).agg(F.count(F.lit(1)).alias("reviews"))
    average = F.try_divide(F.coalesce(total.scalar(), F.lit(0)).cast("double"), F.col("reviews"))
    return count.select(average.alias("avg_words"))


def top_words(
    reviews: DataFrame, from_year: int, stopwords: DataFrame, longer_than: int = 3, n: int = 10
) -> DataFrame:
    """The n most frequent cleaned words above a length, alphabetical on a tie."""
    counts = (
        month_word_counts(reviews, from_year, stopwords)
        .where(F.length("word") > longer_than)
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
    )
    return counts.orderBy(F.desc("n"), "word").limit(n)


def top_states(reviews: DataFrame, businesses: DataFrame, n: int = 5) -> DataFrame:
    """The n states with most reviews, alphabetical on a tie; blank states are left out untrimmed.

    Reviews are counted per business before the join: a popular business is one row there, and the
    join moves counts instead of reviews.
    """
    per_business = reviews.groupBy("business_id").agg(F.count(F.lit(1)).alias("n"))
    named = businesses.where(F.col("state").rlike(NOT_WHITE_SPACE)).select("business_id", "state")
    return (
        per_business.join(named, "business_id")
        .groupBy("state")
        .agg(F.sum("n").alias("reviews"))
        .orderBy(F.desc("reviews"), "state")
        .limit(n)
    )


def years_over(reviews: DataFrame, more_than: int) -> DataFrame:
    """Years with more reviews than the threshold."""
    counts = reviews.groupBy(year_text(reviews).alias("year")).agg(F.count(F.lit(1)).alias("reviews"))
    return counts.where(F.col("reviews") > more_than)
