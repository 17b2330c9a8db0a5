"""Word profiles of businesses and users, and the similarity of the two."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.functions.sets import computed_once, jaccard_of_counts
from tallyweave.operators.skew import spread_join
from tallyweave.storage import written

SENT_WORDS = 1_000_000  # words of all business profiles up to which they are sent to every task


def business_profiles(reviews: DataFrame, terms: DataFrame) -> DataFrame:
    """(business_id, profile): words heaviest first, empty where a business has no term."""
    arrays = terms.groupBy("business_id").agg(
        F.array_sort(F.collect_list(F.struct("place", "word"))).alias("ordered")
    )
    profile = F.coalesce(F.col("ordered.word"), F.expr("cast(array() as array<string>)"))
    return (
        reviews.select("business_id").distinct().join(arrays, "business_id", "left").select("business_id", profile.alias("profile"))
    )


def user_words(reviews: DataFrame, terms: DataFrame) -> DataFrame:
    """Distinct (user_id, word) over the profiles of the businesses a user reviewed.

    Few terms are sent to where a user's visits are, so that the words of a visit are not shuffled.
    """
    visited = reviews.select("user_id", "business_id").distinct()
    words = terms.select("business_id", "word")
    if words.count() <= SENT_WORDS:
        met = visited.repartition("user_id").join(F.broadcast(words), "business_id")
    else:
        met = spread_join(visited, words, ["business_id"])
    return met.select("user_id", "word").distinct()


def user_profiles(reviews: DataFrame, terms: DataFrame) -> DataFrame:
    """(user_id, profile): the union of the profiles, in word order, empty where there is no word.

    A profile holds at most the vocabulary, whose size the rare-word share bounds.
    """
    arrays = user_words(reviews, terms).groupBy("user_id").agg(F.array_sort(F.collect_list("word")).alias("profile"))
    profile = F.coalesce("profile", F.expr("cast(array() as array<string>)"))
    return reviews.select("user_id").distinct().join(arrays, "user_id", "left").select("user_id", profile.alias("profile"))


def profile_scores(
    pairs: DataFrame, businesses: DataFrame, users: DataFrame, least: float = 0.01
) -> DataFrame:
    """(user_id, business_id, sim) of the pairs whose profiles reach the least similarity.

    Every pair is scored once and joined back to its rows, so repeated pairs stay repeated.  A pair
    without one of the profiles scores 0.  Words are compared by their 64-bit hashes.
    """
    wanted = pairs.select("user_id", "business_id").distinct()
    hashed = F.transform("profile", lambda word: F.xxhash64(word))
    of_business = businesses.select("business_id", "profile", hashed.alias("business_words"))
    of_user = users.select("user_id", "profile", hashed.alias("user_words"))
    if least > 0:  # a pair without a word on either side does not pass
        of_business, of_user = (side.where(F.size("profile") > 0) for side in (of_business, of_user))
    how = "inner" if least > 0 else "left"
    of_business = written(of_business.drop("profile"), "business-words")
    of_user = of_user.drop("profile")
    if (of_business.agg(F.sum(F.size("business_words"))).first()[0] or 0) <= SENT_WORDS:
        # Pairs move alone; profiles meet them where they are.
        profiled = wanted.join(of_user, "user_id", how).join(F.broadcast(of_business), "business_id", how)
    else:
        # Business profiles are short; the longer user profiles join last and are not moved per pair.
        profiled = wanted.join(of_business, "business_id", how).join(of_user, "user_id", how)
    size_u = F.coalesce(F.size("user_words"), F.lit(0))
    size_b = F.coalesce(F.size("business_words"), F.lit(0))
    shared = F.coalesce(F.size(F.array_intersect("user_words", "business_words")), F.lit(0))
    sim = F.when((size_u > 0) & (size_b > 0), jaccard_of_counts(F.col("shared"), size_u, size_b)).otherwise(F.lit(0.0))
    scored = (
        computed_once(profiled, "shared", shared)
        .select("user_id", "business_id", sim.alias("sim"))
        .where(F.col("sim") >= least)
    )
    return pairs.select("user_id", "business_id").join(scored, ["user_id", "business_id"])
