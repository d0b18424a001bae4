"""Tables of works: titles, genres, authors, all actions, genders, first books, data sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tomeflow.functions import ids
from tomeflow.operators.graph import first_of


def item_titles(book_ids: DataFrame, book_info: DataFrame, work_info: DataFrame) -> DataFrame:
    """``item_id, work_id, book_id, title``: works by their own title, books without a work by theirs."""
    works = book_ids.where("work_id is not null").select("item_id", "work_id").distinct()
    books = book_ids.where("work_id is null").select("item_id", "book_id").distinct()
    null = F.lit(None).cast("int")
    works = works.join(work_info.select("work_id", "title"), "work_id", "left").select("item_id", "work_id", null.alias("book_id"), "title")
    books = books.join(book_info.select("book_id", "title"), "book_id", "left").select("item_id", null.alias("work_id"), "book_id", "title")
    return books.unionByName(works)


def item_genres(book_ids: DataFrame, book_genres: DataFrame) -> DataFrame:
    return book_ids.select("book_id", "item_id").join(book_genres, "book_id").groupBy("item_id", "genre_id").agg(F.sum("count").alias("count"))


def item_authors(book_ids: DataFrame, book_authors: DataFrame, author_info: DataFrame, first_only: bool = False) -> DataFrame:
    """``item_id, author_id, author_name``; ``first_only`` takes a book's first author without a role."""
    if first_only:
        book_authors = book_authors.where("role is null").groupBy("book_id").agg(first_of("author_id", "position", "author_id").alias("author_id"))
    pairs = book_ids.select("book_id", "item_id").join(book_authors.select("book_id", "author_id"), "book_id").select("item_id", "author_id").distinct()
    return pairs.join(author_info.select("author_id", F.col("name").alias("author_name")), "author_id", "left").select("item_id", "author_id", "author_name")


def all_actions(interactions: DataFrame, book_ids: DataFrame) -> DataFrame:
    return interactions.join(book_ids.select("book_id", "item_id", "work_id"), "book_id").select(
        "user_id", "item_id", "book_id", "work_id", "rating", "is_read", F.col("added").alias("timestamp"), "updated"
    )


def work_genders(book_links: DataFrame, genders: DataFrame, compat: bool = False) -> DataFrame:
    """``item_id, gender``, one row an item; of several clusters the least one's gender."""
    items = book_links.withColumn("item_id", ids.item_code(F.col("work_id"), F.col("book_id"), compat)).select("item_id", "cluster").distinct()
    return items.join(genders, "cluster").groupBy("item_id").agg(first_of("gender", "cluster").alias("gender"))


def work_statistics(interactions: DataFrame, links: DataFrame) -> DataFrame:
    """Shelvings, users, ratings, their mean and the positive ones of every work."""
    rated = F.when(F.col("rating") > 0, F.col("rating"))
    return (
        interactions.join(links.select("book_id", "work_id"), "book_id")
        .groupBy("work_id")
        .agg(
            F.count("rec_id").alias("n_shelves"),
            F.count_distinct("user_id").alias("n_users"),
            F.count(rated).alias("n_rates"),
            F.avg(rated).alias("mean_rate"),
            F.count_if(F.col("rating") > 2).alias("n_pos_rates"),
        )
    )


def first_books(interactions: DataFrame, links: DataFrame, book_info: DataFrame, book_authors: DataFrame, years: tuple[int, int] = (2008, 2012)) -> DataFrame:
    """Statistics of authors' first works published in a span of years, with the authors' numbers of works."""
    info = book_info.join(links.select("book_id", "work_id"), "book_id")
    stats = work_statistics(interactions, links).join(info.groupBy("work_id").agg(F.min("pub_year").alias("pub_year")), "work_id")
    written = book_authors.select("book_id", "author_id").join(info, "book_id").where("pub_year is not null")
    firsts = written.groupBy("author_id").agg(first_of("work_id", "pub_year", "pub_month", "work_id").alias("work_id"))
    chosen = stats.join(firsts, "work_id").where(F.col("pub_year").between(*years))
    counts = written.groupBy("author_id").agg(F.count_distinct("work_id").alias("au_nbooks"))
    return chosen.join(counts, "author_id")


def recommender_dataset(actions: DataFrame, genres: DataFrame, work_genres: DataFrame, titles: DataFrame) -> dict[str, DataFrame]:
    """Tables of a recommender data set: interactions with timestamps, a count of every genre for each item, titles.

    Genres are a fixed, small vocabulary: their names become columns.
    """
    renamed = actions.withColumnsRenamed({"first_time": "timestamp", "last_rating": "rating"})
    interactions = renamed.withColumns({c: F.timestamp_seconds(c) for c in ("timestamp", "last_time") if c in renamed.columns})
    items = actions.select("item_id").distinct()
    names = [r["genre"] for r in genres.orderBy("genre_id").select("genre").collect()]
    vectors = work_genres.join(items, "item_id", "left_semi").join(F.broadcast(genres), "genre_id").groupBy("item_id").pivot("genre", names).agg(F.sum("count"))
    named = titles.groupBy("item_id").agg(first_of("title", "work_id", "book_id", "title").alias("title"))
    return {"interactions": interactions, "genres": vectors.fillna(0), "titles": named.join(items, "item_id", "left_semi")}
