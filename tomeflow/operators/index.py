"""Dense identifiers: numbering, string indexes, the collection and linking of ISBNs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tomeflow.operators.checks import assert_no_nulls, assert_no_orphans
from tomeflow.workspace import Workspace

_ROWS_BITS = 33  # monotonically_increasing_id() has the row's place within its partition in the low bits


def dense_index(df: DataFrame, order: list[str], name: str = "id", start: int = 1) -> DataFrame:
    """Number the rows of ``df`` from ``start`` in the order of the columns ``order``.

    Rows are range-partitioned and sorted; a row's number is the rows of all earlier partitions
    plus its own place.  The only gathered table has a row for each partition.  Ties get adjacent
    numbers in any order, so the order should be total for reproducible numbers.
    """
    ws = Workspace(df.sparkSession, "dense-index")
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_tf_place", F.monotonically_increasing_id())
    dealt = ws.stage(dealt, "sorted")
    part = F.shiftright("_tf_place", _ROWS_BITS)
    counts = dealt.groupBy(part.alias("_tf_part")).agg(F.count("*").alias("n"))
    earlier = Window.orderBy("_tf_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_tf_part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_tf_before"))
    place = F.col("_tf_place").bitwiseAND(F.lit((1 << _ROWS_BITS) - 1))
    return (
        dealt.withColumn("_tf_part", part)
        .join(F.broadcast(offsets), "_tf_part")  # a row for each partition of the sort
        .withColumn(name, F.col("_tf_before") + place + F.lit(start))
        .drop("_tf_part", "_tf_before", "_tf_place")
    )


def in_file_order(df: DataFrame, name: str) -> DataFrame:
    """Number the records of files (read with their ``_metadata``) by file, then by place in it."""
    placed = df.select(
        "*",
        F.col("_metadata.file_path").alias("_tf_file"),
        F.col("_metadata.file_block_start").alias("_tf_block"),
        F.monotonically_increasing_id().alias("_tf_row"),
    )
    return dense_index(placed, ["_tf_file", "_tf_block", "_tf_row"], name).drop("_tf_file", "_tf_block", "_tf_row")


@dataclass
class StringIndex:
    """Distinct keys numbered from 1 in their byte order."""

    table: DataFrame
    key: str = "key"
    id: str = "id"

    @classmethod
    def build(cls, keys: DataFrame, column: str, key: str = "key", id: str = "id") -> StringIndex:
        found = keys.select(F.col(column).alias(key)).where(F.col(key).isNotNull()).distinct()
        return cls(dense_index(found, [key], id).select(F.col(id).cast("int").alias(id), key), key, id)

    def lookup(self, df: DataFrame, column: str, out: str, frozen: bool = False) -> DataFrame:
        """``df`` with the keys' numbers; an unknown key is null, or an error if the index is frozen."""
        if frozen:
            assert_no_orphans(df, column, self.table, self.key)
        side = self.table.select(F.col(self.key).alias("_tf_key"), F.col(self.id).alias(out))
        return df.join(side, F.col(column) == F.col("_tf_key"), "left").drop("_tf_key")

    def intern(self, df: DataFrame, column: str) -> StringIndex:
        """The index with the new keys of a table after its own."""
        top = self.table.agg(F.max(self.id)).first()[0] or 0
        new = df.select(F.col(column).alias(self.key)).where(F.col(self.key).isNotNull()).distinct().join(self.table, self.key, "left_anti")
        added = dense_index(new, [self.key], self.id, top + 1).select(F.col(self.id).cast("int").alias(self.id), self.key)
        return StringIndex(self.table.unionByName(added), self.key, self.id)

    def __len__(self) -> int:
        return self.table.count()

    def save(self, path: str) -> None:
        self.table.write.mode("overwrite").option("compression", "zstd").parquet(path)

    @classmethod
    def load(cls, spark, path: str, key: str = "key", id: str = "id") -> StringIndex:
        read = spark.read.csv(path, header=True, schema=f"`{id}` int, `{key}` string") if path.endswith(".csv") else spark.read.parquet(path)
        return cls(read.select(id, key), key, id)


def collect_ids(sources: dict[str, tuple[DataFrame, list[str]]], key: str = "isbn", id: str = "isbn_id") -> DataFrame:
    """All keys of all sources, numbered in key order, with a column of occurrences for each source.

    A source is a table and the columns that hold keys.  Sources are stacked and counted in one
    grouped pass, where the count of an absent source is 0.
    """
    stacked: DataFrame | None = None
    for source, (table, columns) in sources.items():
        one = table.select(F.explode(F.array(*[F.col(c).cast("string") for c in columns])).alias(key), F.lit(source).alias("_tf_source")).where(F.col(key).isNotNull())
        stacked = one if stacked is None else stacked.unionAll(one)
    if stacked is None:
        raise ValueError("no sources")
    counted = stacked.groupBy(key).agg(*[F.count_if(F.col("_tf_source") == s).alias(s) for s in sources])
    return dense_index(counted, [key], id).select(F.col(id).cast("int").alias(id), key, *sources)


def link_ids(records: DataFrame, rec_col: str, columns: list[str], index: DataFrame, key: str = "isbn", id: str = "isbn_id") -> DataFrame:
    """Distinct ``(record, id)`` of the keys in some columns of the records, in record order; nulls are an error."""
    tall = records.select(F.col(rec_col), F.explode(F.array(*[F.col(c).cast("string") for c in columns])).alias("_tf_key"))
    linked = tall.join(index.select(F.col(key).alias("_tf_key"), id), "_tf_key").select(rec_col, id).distinct()
    return assert_no_nulls(linked, rec_col, id).orderBy(rec_col)


def coalesce_columns(df: DataFrame, columns: list[str], value: Column) -> DataFrame:
    """``df`` with nulls of some columns replaced."""
    return df.withColumns({c: F.coalesce(F.col(c), value) for c in columns})
