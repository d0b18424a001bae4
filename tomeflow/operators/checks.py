"""Assertions on tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def assert_no_nulls(df: DataFrame, *columns: str) -> DataFrame:
    """``df``, or an error that names the columns that hold nulls."""
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    if bad := [c for c in columns if row[c]]:
        raise ValueError(f"nulls in {', '.join(bad)}")
    return df


def assert_no_orphans(df: DataFrame, column: str, known: DataFrame, key: str) -> DataFrame:
    """``df``, or an error if a value of ``column`` is not in ``known``."""
    lost = df.select(F.col(column).alias("v")).where("v is not null").join(known.select(F.col(key).alias("v")), "v", "left_anti")
    if row := lost.first():
        raise ValueError(f"{column} holds {row['v']!r}, which is unknown")
    return df


def duplicated(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their counts."""
    return df.groupBy(column).agg(F.count("*").alias("n")).where("n > 1")


def non_null_columns(df: DataFrame) -> list[str]:
    """Columns without a null, in one pass."""
    row = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns]).first()
    return [c for c in df.columns if not row[c]]
