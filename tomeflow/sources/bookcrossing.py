"""The archive of a book-swapping site: a zip file with a semicolon CSV of ratings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tomeflow.functions.isbn import clean_rating_isbn
from tomeflow.sources.files import read_zip_member

MEMBER = "BX-Book-Ratings.csv"
# Fixed value: the file's first line.
HEADER = '"User-ID";"ISBN";"Book-Rating"'


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """``user, isbn, rating``; characters outside ASCII and carriage returns go, rows without an ISBN go.

    A file with another header is an error.
    """
    lines = read_zip_member(spark, path, MEMBER).select("place", F.regexp_replace("value", r"[^\x00-\x7F]|\r", "").alias("value"))
    refused = F.raise_error(F.lit("the archive has another header")).cast("boolean")
    is_row = F.when(F.col("place") > 0, True).when(F.col("value") != HEADER, refused).otherwise(False)
    fields = F.from_csv(F.replace("value", F.lit(";"), F.lit(",")), F.lit("user int, isbn string, rating float"), {"mode": "FAILFAST"})
    rows = lines.where(is_row).select(fields.alias("f")).select("f.*")
    return rows.withColumn("isbn", clean_rating_isbn(F.col("isbn"))).where("isbn <> ''")
