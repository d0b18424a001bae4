"""k-cores of (user, item) pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tomeflow.workspace import Workspace


def time_range(df: DataFrame, start: int | None = None, end: int | None = None, column: str = "first_time") -> DataFrame:
    """Rows from ``start`` on and before ``end`` (epoch seconds)."""
    if start is not None:
        df = df.where(F.col(column) >= start)
    if end is not None:
        df = df.where(F.col(column) < end)
    return df


def kcore(df: DataFrame, user_k: int = 5, item_k: int = 5, user: str = "user_id", item: str = "item_id", compat: bool = False) -> DataFrame:
    """The largest subset in which every user has ``user_k`` rows and every item ``item_k``.

    A round drops items below their bound, then users below theirs; a table without any is left as
    it is.  Rounds stop when none drops a row.  Only the surviving *keys* are carried from round to
    round (two identifiers a row, written to the shared folder); all columns are joined once, at the
    end.  An empty core is an empty table.  ``compat`` holds users to the items' bound.
    """
    if compat:
        user_k = item_k
    ws = Workspace(df.sparkSession, "kcore")
    # Pairs with their multiplicity: counts stay those of rows, and the carried table is as small as it gets.
    current = ws.stage(df.groupBy(F.col(user).alias("u"), F.col(item).alias("i")).agg(F.count("*").alias("n")), "pairs")
    before = current.agg(F.sum("n")).first()[0] or 0
    while before:
        good_items = current.groupBy("i").agg(F.sum("n").alias("k")).where(F.col("k") >= item_k).select("i")
        kept = current.join(good_items, "i", "left_semi")
        good_users = kept.groupBy("u").agg(F.sum("n").alias("k")).where(F.col("k") >= user_k).select("u")
        after = ws.stage(kept.join(good_users, "u", "left_semi"), "pairs")
        now = after.agg(F.sum("n")).first()[0] or 0
        ws.drop(current)
        current = after
        if now == before:
            break
        before = now
    keys = current.select(F.col("u").alias("_tf_u"), F.col("i").alias("_tf_i"))
    return df.join(keys, (F.col(user) == F.col("_tf_u")) & (F.col(item) == F.col("_tf_i")), "left_semi")
