"""Joins of texts with lists of identifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: So many identifiers of 8 bytes are broadcast at most.
BROADCAST_IDS = 2_000_000
#: Stands for a null identifier; ranks below all others.
NULL_ID = -(1 << 63)


def id_side(ids: DataFrame, limit: int = BROADCAST_IDS) -> DataFrame:
    """A written list of identifiers as one side of a join with texts.

    Up to a counted number of identifiers the list goes to the texts, so that texts stay where they
    are; beyond it both sides are shuffled and sorted.  The choice depends on the count alone.
    """
    return F.broadcast(ids) if ids.count() <= limit else ids.hint("merge")


def keyed(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, bool]:
    """``(id, text_hash, text)`` and whether identifiers are unique; the hash tells rows of one identifier apart and is 0 if they are."""
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID))
    unique = docs.groupBy(key.alias("id")).agg(F.count("*").alias("n")).where("n > 1").isEmpty()
    text_hash = F.lit(0).cast("long") if unique else F.xxhash64(F.col(text_col))
    return docs.select(key.alias("id"), text_hash.alias("text_hash"), F.col(text_col).alias("text")), unique
