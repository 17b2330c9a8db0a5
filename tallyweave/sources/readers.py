"""Readers for the review, business, basket, stopword and model files."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyweave.functions.text import NOT_WHITE_SPACE, WHITE_SPACE
from tallyweave.sources import schemas


_UNREADABLE = "_unreadable"


def split_json_lines(spark: SparkSession, path: str, layout: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(records, bad lines) of a file of JSON objects, one a line.

    A bad line (file, line) is no JSON, no object, more than one value, or has a value that its field
    cannot hold; it gives no record.  An object without a field, or with more, is a record; a blank line is neither.  Both results
    read the file when used.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))
    lines = lines.where(F.col("line").rlike(NOT_WHITE_SPACE))
    marked = T.StructType([*layout.fields, T.StructField(_UNREADABLE, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _UNREADABLE, "allowSingleQuotes": "false"}
    record = F.from_json("line", marked, options)

    def values(behind: str) -> Column:
        return F.json_array_length(F.concat(F.lit("["), "line", F.lit(behind)))

    # The parser stops behind the first object.  A line that closes the array itself has one count in both.
    one_object = F.col("line").rlike(r"^\s*\{") & (values("]") == 1) & (values(",0]") == 2)
    parsed = lines.select("file", "line", record.alias("record"), F.coalesce(one_object, F.lit(False)).alias("one_object"))
    bad = ~F.col("one_object") | F.col("record").isNull() | F.col(f"record.{_UNREADABLE}").isNotNull()
    records = parsed.where(~bad).select(*[F.col(f"record.{name}").alias(name) for name in layout.names])
    return records, parsed.where(bad).select("file", "line")


def _read_json(spark: SparkSession, path: str, layout: T.StructType, quarantine: str | None) -> DataFrame:
    if quarantine is None:
        return spark.read.schema(layout).json(path)
    records, bad = split_json_lines(spark, path, layout)
    bad.write.json(quarantine)
    return records


def read_reviews(spark: SparkSession, path: str, quarantine: str | None = None) -> DataFrame:
    """Review records, one JSON object a line.

    Unreadable lines give null fields.  With a folder for ``quarantine`` they give no record and are
    written there as JSON lines of file and line, as with the other JSON readers.
    """
    return _read_json(spark, path, schemas.REVIEW, quarantine)


def read_businesses(spark: SparkSession, path: str, quarantine: str | None = None) -> DataFrame:
    """Business records with their state, one JSON object a line."""
    return _read_json(spark, path, schemas.BUSINESS, quarantine)


def read_year_baskets(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header line and the columns year, user, business, rating by position."""
    return spark.read.schema(schemas.YEAR_BASKET).csv(path, header=True, enforceSchema=True)


def read_user_business(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header line and the columns user, business by position; line ends are trimmed."""
    return (
        spark.read.schema(schemas.USER_BUSINESS)
        .csv(path, header=True, enforceSchema=True)
        .select(
            F.regexp_replace("user_id", f"^{WHITE_SPACE}", "").alias("user_id"),
            F.regexp_replace("business_id", f"{WHITE_SPACE}$", "").alias("business_id"),
        )
    )


def read_stopwords(spark: SparkSession, path: str, normalise: bool) -> DataFrame:
    """One word a line: trimmed and lowercased for the review report, verbatim for the content model."""
    line = F.col("value")
    word = F.lower(F.regexp_replace(line, f"^{WHITE_SPACE}|{WHITE_SPACE}$", "")) if normalise else line
    return spark.read.text(path).select(word.alias("word")).distinct()


def read_pairs(spark: SparkSession, path: str, quarantine: str | None = None) -> DataFrame:
    """User-business pairs to score, one JSON object a line; repeated lines are kept."""
    return _read_json(spark, path, schemas.USER_BUSINESS, quarantine)


def read_item_edges(spark: SparkSession, path: str, quarantine: str | None = None) -> DataFrame:
    """Item similarity model stored as JSON lines."""
    return _read_json(spark, path, schemas.ITEM_EDGE, quarantine)


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """The (file, line) rows that a reader set apart."""
    return spark.read.schema("file string, line string").json(path)


def read_profiles(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Content model stored as JSON lines: (item profiles, user profiles).

    A line is ``{"business": id, "profile": [...]}``, ``{"user": id, "profile": [...]}`` or the older
    ``{id: [...]}``, where an id starting with 'u' is a user.
    """
    lines = spark.read.text(path).select(
        F.from_json("value", schemas.PROFILE).alias("tagged"), F.col("value")
    )
    is_tagged = F.col("tagged.profile").isNotNull() & (
        F.col("tagged.business").isNotNull() | F.col("tagged.user").isNotNull()
    )
    tagged = lines.where(is_tagged).select("tagged.*")
    older = (
        lines.where(~F.coalesce(is_tagged, F.lit(False)))
        .select(F.map_entries(F.from_json("value", "map<string,array<string>>")).alias("entries"))
        .where(F.size("entries") == 1)
        .select(F.col("entries")[0]["key"].alias("id"), F.col("entries")[0]["value"].alias("profile"))
    )
    is_user = F.col("id").startswith("u")
    items = tagged.where(F.col("business").isNotNull()).select(
        F.col("business").alias("business_id"), "profile"
    )
    users = tagged.where(F.col("business").isNull()).select(F.col("user").alias("user_id"), "profile")
    return (
        items.unionByName(older.where(~is_user).select(F.col("id").alias("business_id"), "profile")),
        users.unionByName(older.where(is_user).select(F.col("id").alias("user_id"), "profile")),
    )
