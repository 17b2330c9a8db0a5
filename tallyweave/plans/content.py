"""Content model: word profiles from review text, kept as two tables, and pair scores from it."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tallyweave.operators import profiles, tfidf
from tallyweave.sources.writers import write_profiles
from tallyweave.storage import written


@dataclass(frozen=True)
class ContentModel:
    businesses: DataFrame  # business_id, profile
    users: DataFrame  # user_id, profile

    def save(self, path: str, mode: str = "errorifexists") -> None:
        """Two parquet tables."""
        self.businesses.write.mode(mode).parquet(f"{path}/businesses")
        self.users.write.mode(mode).parquet(f"{path}/users")

    def export_json(self, path: str, mode: str = "errorifexists") -> None:
        """Tagged JSON lines."""
        write_profiles(self.businesses, self.users, path, mode)

    def score(self, pairs: DataFrame, least: float = 0.01) -> DataFrame:
        return profiles.profile_scores(pairs, self.businesses, self.users, least)


def load_content_model(spark: SparkSession, path: str) -> ContentModel:
    return ContentModel(spark.read.parquet(f"{path}/businesses"), spark.read.parquet(f"{path}/users"))


def build_content_model(
    reviews: DataFrame,
    stopwords: DataFrame,
    rare_share: float = tfidf.RARE_SHARE,
    words: int = tfidf.PROFILE_WORDS,
) -> ContentModel:
    terms = written(tfidf.top_terms(tfidf.term_weights(reviews, stopwords, rare_share), words), "profile-terms")
    return ContentModel(profiles.business_profiles(reviews, terms), profiles.user_profiles(reviews, terms))
