"""Aggregation of ratings and shelf actions to (user, item) pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tomeflow.functions import ids


def link_items(interactions: DataFrame, clusters: DataFrame, key: str, cluster_key: str, cluster: str = "cluster", item: str = "item_id") -> DataFrame:
    """Interactions with the cluster of their key as item; those without a cluster go."""
    side = clusters.select(F.col(cluster_key).alias("_tf_key"), F.col(cluster).alias(item))
    kept = [c for c in interactions.columns if c != item]
    return interactions.select(*kept).join(side, F.col(key) == F.col("_tf_key")).drop("_tf_key")


def cluster_ratings(df: DataFrame, user: str = "user_id", item: str = "item_id", rating: str = "rating", time: str | None = "timestamp", order: str | None = None) -> DataFrame:
    """Median, last rating, first and last time and number of ratings of each pair.

    The last rating is that of the greatest ``order`` (the time unless given, such as the record
    number of a feed), ties by the larger rating.  Without a time there are no times, and no last.
    """
    aggs: list[Column] = [F.median(rating).alias("rating")]
    by = order or time
    if by:
        aggs.append(F.max_by(F.col(rating), F.struct(F.col(by), F.col(rating))).alias("last_rating"))
    if time:
        aggs += [F.min(time).alias("first_time"), F.max(time).alias("last_time")]
    return df.groupBy(F.col(user).alias("user_id"), F.col(item).alias("item_id")).agg(*aggs, F.count("*").alias("nratings"))


def cluster_actions(df: DataFrame, user: str = "user_id", item: str = "item_id", time: str | None = "timestamp", rating: str | None = "rating", order: str | None = None) -> DataFrame:
    """First and last time, number of actions and last rating that is not null, in one aggregation."""
    aggs: list[Column] = []
    if time:
        aggs += [F.min(time).alias("first_time"), F.max(time).alias("last_time")]
    aggs.append(F.count("*").alias("nactions"))
    by = order or time
    if rating and by:
        rated = F.when(F.col(rating).isNotNull(), F.struct(F.col(by), F.col(rating)))
        aggs.append(F.max_by(F.col(rating), rated).alias("last_rating"))
    return df.groupBy(F.col(user).alias("user_id"), F.col(item).alias("item_id")).agg(*aggs)


def native_items(df: DataFrame, work: str = "work_id", book: str = "book_id", compat: bool = False) -> DataFrame:
    """Rows with the code of their work, or else of their book, as item."""
    return df.withColumn("item_id", ids.item_code(F.col(work), F.col(book), compat))


def explicit_only(df: DataFrame, rating: str = "rating") -> DataFrame:
    return df.where(F.col(rating) > 0)


def dedup_with_median_time(df: DataFrame, user: str = "user_id", item: str = "item_id", rating: str = "rating", time: str = "timestamp") -> DataFrame:
    """Rating and time of the median rating of each pair, the last rating and the number.

    Ratings are ranked by their tenths, ties by time.  Of an even number, the two middle ones give
    the mean rating and the whole part of the mean time.  A null rating is an error.
    """
    checked = F.coalesce(F.col(rating), F.raise_error(F.lit("a rating is null")).cast("double"))
    row = F.struct(F.floor(checked * 10).cast("int").alias("tenths"), F.col(time).alias("t"), checked.alias("r"))
    grouped = df.groupBy(F.col(user).alias("user_id"), F.col(item).alias("item_id")).agg(
        F.array_sort(F.collect_list(row)).alias("s"), F.max_by(F.col(rating), F.struct(F.col(time), F.col(rating))).alias("last_rating")
    )
    n = F.size("s")
    upper, lower = F.element_at("s", F.floor(n / 2).cast("int") + 1), F.element_at("s", F.greatest(F.floor(n / 2).cast("int"), F.lit(1)))
    odd = n % 2 == 1
    return grouped.select(
        "user_id",
        "item_id",
        F.when(odd, upper["r"]).otherwise((lower["r"] + upper["r"]) / 2).alias("rating"),
        F.when(odd, upper["t"]).otherwise(F.floor((lower["t"] + upper["t"]) / 2).cast("bigint")).alias("timestamp"),
        "last_rating",
        n.cast("long").alias("nratings"),
    )


def keep_unclustered(df: DataFrame, links: DataFrame, key: str, cluster_key: str, cluster: str = "cluster", namespace: str = "ISBN") -> DataFrame:
    """The older rule: a key without a cluster stands for itself, as a code of its namespace."""
    side = links.select(F.col(cluster_key).alias("_tf_key"), F.col(cluster).alias("_tf_cluster"))
    code = (F.col(key) + F.lit(ids.base(namespace))).cast("int")
    return df.join(side, F.col(key) == F.col("_tf_key"), "left").withColumn("item_id", F.coalesce("_tf_cluster", code)).drop("_tf_key", "_tf_cluster")


def without(df: DataFrame, column: str, unwanted: DataFrame, key: str) -> DataFrame:
    """Rows whose value is in no row of ``unwanted``; a null value is never unwanted."""
    return df.join(unwanted.select(F.col(key).alias("_tf_key")), F.col(column) == F.col("_tf_key"), "left_anti")
