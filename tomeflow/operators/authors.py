"""Authors of clusters and their genders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tomeflow.functions import gender as g
from tomeflow.functions import ids
from tomeflow.functions.text import clean_name, map_distinct


def edition_authors(clusters: DataFrame, isbns: DataFrame, authors: DataFrame, names: DataFrame, first_only: bool = False) -> DataFrame:
    """``cluster, author_name`` by way of editions: clusters, their ISBNs' editions, these authors, their names."""
    if first_only:
        authors = authors.where("pos = 0")
    return (
        clusters.select("isbn_id", "cluster")
        .join(isbns.select("isbn_id", "edition"), "isbn_id")
        .join(authors.select("edition", "author"), "edition")
        .join(names.select(F.col("id").alias("author"), F.col("name").alias("author_name")), "author")
        .select("cluster", "author_name")
    )


def catalogue_authors(clusters: DataFrame, isbns: DataFrame, authors: DataFrame) -> DataFrame:
    """``cluster, author_name`` by way of catalogue records."""
    return clusters.select("isbn_id", "cluster").join(isbns.select("isbn_id", "rec_id"), "isbn_id").join(authors.select("rec_id", "author_name"), "rec_id").select("cluster", "author_name")


def cluster_authors(*sources: DataFrame, clean: bool = True) -> DataFrame:
    """Distinct, non-empty ``cluster, author_name`` of all sources; each distinct name is cleaned once."""
    every = sources[0]
    for source in sources[1:]:
        every = every.unionByName(source)
    every = every.distinct()
    if clean:
        every = map_distinct(every, "author_name", clean_name, "_tf_clean").select("cluster", F.col("_tf_clean").alias("author_name"))
    return every.where("author_name is not null and author_name <> ''").distinct()


def record_genders(genders: DataFrame, rec: str = "rec_id", value: str = "gender") -> DataFrame:
    """One merged gender for each authority record."""
    return genders.groupBy(F.col(rec).alias("rec_id")).agg(g.merge_genders(g.parse_gender(F.col(value))).alias("gender"))


def name_table(index: DataFrame, genders: DataFrame) -> DataFrame:
    """For each author name: how many authority entries it has, and their merged gender (null if none is known)."""
    return (
        index.select("rec_id", "name")
        .join(record_genders(genders), "rec_id", "left")
        .groupBy("name")
        .agg(F.count("*").alias("n_author_recs"), g.merge_genders(F.col("gender")).alias("gender"))
    )


def cluster_genders(clusters: DataFrame, authors: DataFrame, names: DataFrame) -> DataFrame:
    """``cluster, gender`` of every cluster: the merged gender, or which link is missing."""
    book_authors = authors.join(names, authors["author_name"] == names["name"], "left")
    bags = book_authors.groupBy("cluster").agg(
        F.count("*").alias("n_book_authors"), F.coalesce(F.sum("n_author_recs"), F.lit(0)).alias("n_author_recs"), g.merge_genders(F.col("gender")).alias("merged")
    )
    status = g.cluster_status(F.col("n_book_authors"), F.col("n_author_recs"), F.col("merged"), ids.in_namespace(F.col("cluster"), "ISBN"))
    return clusters.select("cluster").distinct().join(bags, "cluster", "left").select("cluster", status.alias("gender"))
