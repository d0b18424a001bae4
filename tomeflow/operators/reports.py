"""Reports on clusters, links and versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Outcomes in the order of reports; a link failure is listed from the last step to the first.
RESOLVED = ["female", "male", "ambiguous", "unknown"]
UNLINKED = ["no-gender", "no-author-rec", "no-book-author", "no-book"]


def gender_coverage(name: str, items: DataFrame, genders: DataFrame, item: str = "item_id", actions: bool = True) -> DataFrame:
    """Distinct books and rows of a data set by the gender of its clusters."""
    side = genders.select(F.col("cluster").alias("_tf_cluster"), "gender")
    joined = items.select(F.col(item).alias("_tf_item")).join(side, F.col("_tf_item") == F.col("_tf_cluster"))
    rows = F.count("_tf_item") if actions else F.lit(None).cast("bigint")
    return joined.groupBy("gender").agg(F.count_distinct("_tf_item").alias("n_books"), F.count("_tf_item").alias("_tf_n")).select(
        F.lit(name).alias("dataset"), "gender", "n_books", (F.col("_tf_n") if actions else rows).alias("n_actions")
    )


def integration_stats(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def pivot_counts(stats: DataFrame, value: str, index: str = "dataset", columns: str = "gender", values: list[str] | None = None) -> DataFrame:
    return stats.groupBy(index).pivot(columns, values or RESOLVED + UNLINKED).agg(F.sum(value))


def fractionalize(table: DataFrame, index: str, columns: list[str], unlinked: list[str] | None = None) -> DataFrame:
    """Columns (and the sum of some others) as shares of the row's total; absent counts are none."""
    zero = lambda c: F.coalesce(F.col(f"`{c}`"), F.lit(0))
    parts: dict[str, Column] = {c: zero(c) for c in columns}
    if unlinked:
        parts["unlinked"] = sum((zero(c) for c in unlinked[1:]), zero(unlinked[0]))
    total = sum(parts.values(), F.lit(0))
    return table.select(index, *[F.try_divide(p.cast("double"), total).alias(c) for c, p in parts.items()])


def coverage(table: DataFrame, index: str = "dataset", linked: tuple[str, ...] = ("male", "female", "ambiguous"), every: list[str] | None = None) -> DataFrame:
    zero = lambda c: F.coalesce(F.col(f"`{c}`"), F.lit(0))
    total = sum((zero(c) for c in every or RESOLVED + UNLINKED), F.lit(0))
    return table.select(index, F.try_divide(sum((zero(c) for c in linked), F.lit(0)).cast("double"), total).alias("coverage"))


def size_histogram(clusters: DataFrame, cluster: str = "cluster") -> DataFrame:
    sizes = clusters.groupBy(cluster).agg(F.count("*").alias("size"))
    return sizes.groupBy("size").agg(F.count("*").alias("count"))


def sources_present(stats: DataFrame, columns: list[str]) -> DataFrame:
    """How many rows have a positive count, by column."""
    return stats.agg(*[F.count_if(F.col(c) > 0).alias(c) for c in columns])


def top(df: DataFrame, n: int, by: str, *ties: str) -> DataFrame:
    """The n rows of the largest value, ties by other columns: a top-n report."""
    return df.orderBy(F.desc(by), *ties).limit(n)


def cumulative_fraction(histogram: DataFrame, order: str, count: str = "count", within: str | None = None, out: str = "cum_frac") -> DataFrame:
    """Running share of a histogram, in the order of a column.

    The window runs over the histogram's rows, of which there are as many as distinct values.
    """
    keys = [within] if within else []
    running = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return histogram.withColumn(out, F.sum(count).over(running) / F.sum(count).over(whole))


def version_rows(wide: DataFrame, ids: list[str], versions: list[str], name: str = "version", value: str = "cluster") -> DataFrame:
    """A row for each version that has a value."""
    return wide.select(*ids, *versions).unpivot(ids, versions, name, value).where(F.col(value).isNotNull())


def version_sizes(tall: DataFrame, version: str = "version", cluster: str = "cluster") -> DataFrame:
    return tall.groupBy(version, cluster).agg(F.count("*").alias("size"))


def version_metrics(sizes: DataFrame, version: str = "version") -> DataFrame:
    return sizes.groupBy(version).agg(F.sum("size").alias("n_isbns"), F.count("*").alias("n_clusters"), F.max("size").alias("max_size"))


def change_status(old: Column, new: Column) -> Column:
    return F.when(old.isNull() & new.isNotNull(), "added").when(old.isNotNull() & new.isNull(), "dropped").when(old != new, "changed").otherwise("same")


def trajectories(wide: DataFrame, versions: list[str]) -> DataFrame:
    """Counts, shares and running shares of the sequences of changes from version to version, largest first."""
    steps = [change_status(F.col(a), F.col(b)).alias(b) for a, b in zip(versions, versions[1:])]
    counted = wide.select(*steps).groupBy(*versions[1:]).agg(F.count("*").alias("count"))
    # At most four statuses a step: the table is as small as the number of versions allows.
    order = Window.orderBy(F.desc("count"), *versions[1:])
    whole = Window.partitionBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("count").over(whole)
    return counted.select(
        "*", (F.col("count") / total).alias("fraction"), (F.sum("count").over(order.rowsBetween(Window.unboundedPreceding, 0)) / total).alias("cum_frac")
    )


def changes_by_version(wide: DataFrame, versions: list[str]) -> DataFrame:
    """ISBNs added, dropped and changed at every version after the first."""
    steps = F.array(*[F.struct(F.lit(b).alias("version"), change_status(F.col(a), F.col(b)).alias("s")) for a, b in zip(versions, versions[1:])])
    tall = wide.select(F.explode(steps).alias("x")).select("x.*")
    return tall.groupBy("version").agg(*[F.count_if(F.col("s") == s).alias(f"{n}_isbns") for n, s in (("new", "added"), ("dropped", "dropped"), ("changed", "changed"))])


def join_versions(tables: dict[str, DataFrame], key: str, value: str) -> DataFrame:
    """A column for each version, of all keys that any version has, in one grouped pass."""
    tall = None
    for version, table in tables.items():
        one = table.select(key, F.lit(version).alias("_tf_version"), F.col(value).alias("_tf_value"))
        tall = one if tall is None else tall.unionAll(one)
    return tall.groupBy(key).agg(*[F.max(F.when(F.col("_tf_version") == v, F.col("_tf_value"))).alias(v) for v in tables])


def crosstab(df: DataFrame, row: str, column: str, values: list[str]) -> DataFrame:
    return df.groupBy(row).pivot(column, values).agg(F.count(F.lit(1))).fillna(0)


def describe(df: DataFrame, column: str, quantiles: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Count, mean, standard deviation, extremes and exact quantiles of a column."""
    return df.agg(
        F.count(column).alias("count"), F.avg(column).alias("mean"), F.stddev(column).alias("std"), F.min(column).alias("min"),
        *[F.expr(f"percentile({column}, {q})").alias(f"q{int(q * 100)}") for q in quantiles], F.max(column).alias("max"),
    )
