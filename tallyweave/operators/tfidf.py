"""Word weights of businesses from the text of their reviews."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.functions.text import words_without_marks

RARE_SHARE = 0.0001
PROFILE_WORDS = 100
_TIE_DIGITS = 12
_BROADCAST_WORDS = 1_000_000  # a vocabulary up to this bound may be sent to every task


def business_word_counts(reviews: DataFrame, stopwords: DataFrame) -> DataFrame:
    """(business_id, word, n) of cleaned words; stopwords join counts, not tokens."""
    counts = (
        reviews.select("business_id", F.explode(words_without_marks(F.col("text"))).alias("word"))
        .where(F.col("word") != "")
        .groupBy("business_id", "word")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counts.join(stopwords.select("word"), "word", "left_anti").select("business_id", "word", "n")


def common_words(counts: DataFrame, rare_share: float = RARE_SHARE) -> DataFrame:
    """(word, n) of the words that make up at least ``rare_share`` of all tokens.

    There are at most 1 / rare_share of them.
    """
    totals = counts.groupBy("word").agg(F.sum("n").alias("n"))
    tokens = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"))
    return totals.where(F.col("n") >= F.lit(rare_share) * tokens.scalar())


def term_weights(reviews: DataFrame, stopwords: DataFrame, rare_share: float = RARE_SHARE) -> DataFrame:
    """(business_id, word, n, tf, df, tfidf) over the common words.

    tf is the share of the business's common words, df the businesses with the word, and idf the
    natural log of all reviewed businesses over df.
    """
    if rare_share <= 0:
        raise ValueError("rare_share must be positive; it bounds the vocabulary")
    counts = business_word_counts(reviews, stopwords)
    # The vocabulary has at most 1 / rare_share words, and so has each business after this join.
    bounded = rare_share * _BROADCAST_WORDS >= 1
    sent = F.broadcast if bounded else (lambda words: words)
    kept = counts.join(sent(common_words(counts, rare_share).select("word")), "word")
    documents = reviews.agg(F.count_distinct("business_id").alias("documents"))
    frequency = kept.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy("business_id"))
    weighted = kept.withColumn("tf", share).join(sent(frequency), "word")
    idf = F.ln(documents.scalar() / F.col("df"))
    return weighted.select("business_id", "word", "n", "tf", "df", (F.col("tf") * idf).alias("tfidf"))


def top_terms(weights: DataFrame, words: int = PROFILE_WORDS) -> DataFrame:
    """(business_id, word, place) of the heaviest words, alphabetical where weights are equal.

    Weights equal to 12 decimals are taken as equal, so rounding in the logarithm cannot order them.
    """
    order = Window.partitionBy("business_id").orderBy(F.desc(F.round("tfidf", _TIE_DIGITS)), "word")
    return (
        weights.withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= words)
        .select("business_id", "word", "place")
    )
