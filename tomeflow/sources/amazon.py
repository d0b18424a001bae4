"""Product ratings and reviews."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tomeflow.functions.text import trim_unicode
from tomeflow.operators.index import StringIndex, in_file_order
from tomeflow.sources.files import read_csv

RATING = "{0} string, {1} string, rating float, timestamp long"
REVIEW = "reviewerID string, asin string, overall float, unixReviewTime long, summary string, reviewText string, verified boolean"


def read_ratings(spark: SparkSession, path: str, swap: bool = False) -> DataFrame:
    """``user, asin, rating, timestamp`` of files without a header; ``swap`` for those with the product first."""
    columns = ("asin", "user") if swap else ("user", "asin")
    return read_csv(spark, path, RATING.format(*columns), header=False).select("user", "asin", "rating", "timestamp")


def rating_tables(ratings: DataFrame) -> dict[str, DataFrame]:
    users = StringIndex.build(ratings, "user", "user", "user_id")
    return {"ratings": users.lookup(ratings, "user", "user_id").select("user_id", "asin", "rating", "timestamp"), "users": users.table}


def read_reviews(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema(REVIEW).json(path, mode="FAILFAST").select("*", "_metadata")
    return in_file_order(rows, "rec_id").select(
        "rec_id", F.col("reviewerID").alias("user"), "asin", F.col("overall").alias("rating"), F.col("unixReviewTime").alias("timestamp"), "summary", F.col("reviewText").alias("text"), "verified"
    )


def review_tables(reviews: DataFrame) -> dict[str, DataFrame]:
    """Ratings of all rows, and reviews of those with a summary or a text."""
    users = StringIndex.build(reviews, "user", "user", "user_id")
    numbered = users.lookup(reviews, "user", "user_id")
    clean = lambda c: trim_unicode(F.coalesce(F.col(c), F.lit(""))).alias(c)
    written = numbered.where("summary is not null or text is not null")
    return {
        "ratings": numbered.select("user_id", "asin", "rating", "timestamp"),
        "reviews": written.select("user_id", "asin", "rating", "timestamp", clean("summary"), clean("text")),
        "users": users.table,
    }
