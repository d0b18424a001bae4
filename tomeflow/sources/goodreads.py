"""Dumps of a social reading site: JSON lines whose values are mostly texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tomeflow.functions.dates import feed_seconds
from tomeflow.functions.ids import hex_xor, item_code
from tomeflow.functions.isbn import clean_asin
from tomeflow.functions.text import parse_opt, trim_opt
from tomeflow.operators.checks import duplicated
from tomeflow.operators.index import StringIndex, dense_index, in_file_order

LEAST_ISBN = 7

BOOK = (
    "book_id string, work_id string, isbn string, isbn13 string, asin string, title string, "
    "authors array<struct<author_id:string,role:string>>, publication_year string, publication_month string, publication_day string, series array<string>"
)
WORK = "work_id string, original_title string, original_publication_year string, original_publication_month string, original_publication_day string"
AUTHOR = "author_id string, name string"
GENRES = "book_id string, genres map<string,int>"
INTERACTION = (
    "user_id string, book_id string, review_id string, is_read boolean, isRead boolean, rating float, "
    "date_added string, date_updated string, read_at string, started_at string"
)
REVIEW = INTERACTION + ", review_text string, n_votes int"


def read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The file's objects with ``rec_id``, their place in it."""
    lines = spark.read.schema(schema).json(path, mode="FAILFAST").select("*", "_metadata")
    return in_file_order(lines, "rec_id").drop("_metadata")


def _identifier(c: str) -> Column:
    cleaned = clean_asin(trim_opt(F.col(c)))
    return F.when(F.char_length(cleaned) >= LEAST_ISBN, cleaned)


def book_tables(books: DataFrame) -> dict[str, DataFrame]:
    book, work = F.col("book_id").cast("int"), parse_opt(F.col("work_id"), "int")
    authors = books.select(book.alias("book_id"), F.posexplode("authors").alias("p", "a"))
    return {
        "book_ids": books.select(
            book.alias("book_id"), work.alias("work_id"), item_code(work, book).alias("item_id"),
            _identifier("isbn").alias("isbn10"), _identifier("isbn13").alias("isbn13"), _identifier("asin").alias("asin"),
        ),
        "book_info": books.select(
            book.alias("book_id"), trim_opt(F.col("title")).alias("title"),
            parse_opt(F.col("publication_year"), "int").alias("pub_year"), parse_opt(F.col("publication_month"), "short").alias("pub_month"),
        ),
        "book_authors": authors.select(
            "book_id", F.col("a.author_id").cast("int").alias("author_id"), (F.col("p") + 1).cast("short").alias("position"), F.nullif("a.role", F.lit("")).alias("role")
        ),
        "book_series": books.select(book.alias("book_id"), F.explode("series").alias("series")),
    }


def work_info(works: DataFrame) -> DataFrame:
    return works.select(
        F.col("work_id").cast("int").alias("work_id"), trim_opt(F.col("original_title")).alias("title"),
        parse_opt(F.col("original_publication_year"), "short").alias("pub_year"), parse_opt(F.col("original_publication_month"), "short").alias("pub_month"),
    )


def author_info(authors: DataFrame) -> DataFrame:
    return authors.select(F.col("author_id").cast("int").alias("author_id"), F.nullif("name", F.lit("")).alias("name"))


def genre_tables(books: DataFrame) -> dict[str, DataFrame]:
    """Genres are numbered in the order of their names."""
    tall = books.select(F.col("book_id").cast("int").alias("book_id"), F.explode("genres").alias("genre", "count"))
    genres = dense_index(tall.select("genre").distinct(), ["genre"], "genre_id").select(F.col("genre_id").cast("int").alias("genre_id"), "genre")
    return {"book_genres": tall.join(genres, "genre").select("book_id", "genre_id", "count"), "genres": genres}


def _when(c: str) -> Column:
    return feed_seconds(trim_opt(F.col(c)))


def _positive(c: str) -> Column:
    return F.when(F.col(c) > 0, F.col(c))


def interaction_tables(rows: DataFrame, users: StringIndex | None = None) -> dict[str, DataFrame]:
    """Interactions with numbered users (in the order of their keys), and the users.

    Times are epoch seconds as 32-bit floats; a rating of 0 is none.
    """
    index = users or StringIndex.build(rows, "user_id", "user", "user_id")
    numbered = index.lookup(rows, "user_id", "_tf_user", frozen=users is not None)
    out = numbered.select(
        F.col("rec_id"), hex_xor(F.col("review_id")).alias("review_id"), F.col("_tf_user").alias("user_id"), F.col("book_id").cast("int").alias("book_id"),
        F.coalesce("is_read", "isRead").cast("short").alias("is_read"), _positive("rating").alias("rating"),
        _when("date_added").alias("added"), _when("date_updated").alias("updated"), _when("started_at").alias("read_started"), _when("read_at").alias("read_finished"),
    )
    return {"interactions": out, "users": index.table}


def duplicate_reviews(interactions: DataFrame) -> DataFrame:
    return duplicated(interactions, "review_id")


def suspect_times(interactions: DataFrame, column: str, first_year: int) -> DataFrame:
    """Rows whose time lies before a year."""
    return interactions.where(F.year(F.timestamp_seconds(F.col(column).cast("long"))) < first_year)


def review_table(rows: DataFrame, users: StringIndex, books: DataFrame) -> DataFrame:
    """Reviews with users, works and items; a user or book that the other tables lack is an error."""
    from tomeflow.operators.checks import assert_no_orphans

    numbered = users.lookup(rows, "user_id", "_tf_user", frozen=True).withColumn("book_id", F.col("book_id").cast("int"))
    assert_no_orphans(numbered, "book_id", books, "book_id")
    return numbered.join(books.select("book_id", "work_id", "item_id"), "book_id").select(
        "rec_id", hex_xor(F.col("review_id")).alias("review_id"), F.col("_tf_user").alias("user_id"), "book_id", "work_id", "item_id",
        F.coalesce("is_read", "isRead").cast("short").alias("is_read"), _positive("rating").alias("rating"), F.col("n_votes"),
        _when("date_added").alias("added"), _when("date_updated").alias("updated"), F.col("review_text").alias("review"),
    )
