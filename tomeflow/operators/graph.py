"""The identifier graph: nodes, edges, clusters and their tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tomeflow.functions import ids
from tomeflow.operators.checks import assert_no_nulls, assert_no_orphans
from tomeflow.operators.components import connected_components


def node_source(table: DataFrame, column: str, namespace: str, label: str | None = None) -> DataFrame:
    """``book_code, label`` of the records of one source."""
    code = ids.to_code(F.col(column), namespace)
    text = F.col(label).cast("string") if label else F.lit(None).cast("string")
    return table.where(F.col(column).isNotNull()).select(code.alias("book_code"), text.alias("label"))


def edge_source(table: DataFrame, src: str, src_namespace: str, dst: str, dst_namespace: str) -> DataFrame:
    """``src, dst`` codes of one link table; rows with a null end are no edges."""
    return table.where(F.col(src).isNotNull() & F.col(dst).isNotNull()).select(
        ids.to_code(F.col(src), src_namespace).alias("src"), ids.to_code(F.col(dst), dst_namespace).alias("dst")
    )


def union_nodes(*sources: DataFrame) -> DataFrame:
    """Every code once, with a label if any source has one (the least of several)."""
    return reduce(DataFrame.unionByName, sources).groupBy("book_code").agg(F.min("label").alias("label"))


def union_edges(*sources: DataFrame) -> DataFrame:
    """All edges, each as often as it occurs."""
    return reduce(DataFrame.unionByName, sources)


def catalogue_nodes(t: dict[str, DataFrame], with_reader_data: bool = True) -> DataFrame:
    """Nodes of the standard tables; a work that only an edition names is a node too."""
    works = t["works"].select(F.col("id").alias("work"), "key").unionByName(t["edition_works"].select("work", F.lit(None).cast("string").alias("key")))
    sources = [
        node_source(t["all_isbns"], "isbn_id", "ISBN", "isbn"),
        node_source(t["book_ids"], "rec_id", "LOC"),
        node_source(t["editions"], "id", "OL-E", "key"),
        node_source(works, "work", "OL-W", "key"),
    ]
    if with_reader_data:
        sources += [node_source(t["gr_book_ids"], "book_id", "GR-B"), node_source(t["gr_book_ids"].select("work_id").distinct(), "work_id", "GR-W")]
    return union_nodes(*sources)


def catalogue_edges(t: dict[str, DataFrame], with_reader_data: bool = True) -> DataFrame:
    sources = [
        edge_source(t["book_isbn_ids"], "isbn_id", "ISBN", "rec_id", "LOC"),
        edge_source(t["edition_isbn_ids"], "isbn_id", "ISBN", "edition", "OL-E"),
        edge_source(t["edition_works"], "edition", "OL-E", "work", "OL-W"),
    ]
    if with_reader_data:
        sources += [edge_source(t["gr_book_isbn_ids"], "isbn_id", "ISBN", "book_id", "GR-B"), edge_source(t["gr_book_ids"], "book_id", "GR-B", "work_id", "GR-W")]
    return union_edges(*sources)


def cluster_graph(nodes: DataFrame, edges: DataFrame, check: bool = True) -> DataFrame:
    """Nodes with their cluster, the least code of their component; an edge to no node is an error."""
    if check:
        ends = edges.select(F.explode(F.array("src", "dst")).alias("end"))
        assert_no_orphans(ends, "end", nodes, "book_code")
    found = connected_components(edges).select(F.col("node").alias("book_code"), F.col("component").alias("cluster"))
    return nodes.join(found, "book_code", "left").withColumn("cluster", F.coalesce("cluster", "book_code"))


def isbn_clusters(clustered: DataFrame) -> DataFrame:
    """``isbn_id, isbn, cluster``; an ISBN without its text is an error."""
    found = clustered.where(ids.in_namespace(F.col("book_code"), "ISBN")).select(
        ids.from_code(F.col("book_code"), "ISBN").alias("isbn_id"), F.col("label").alias("isbn"), "cluster"
    )
    return assert_no_nulls(found, "isbn")


def graph_nodes(clustered: DataFrame) -> DataFrame:
    return clustered.select("book_code", ids.namespace_name(F.col("book_code")).alias("node_type"), "label", "cluster")


def graph_edges(clustered: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges with their cluster, each as often as it occurs."""
    return edges.join(clustered.select(F.col("book_code").alias("src"), "cluster"), "src").select("src", "dst", "cluster")


#: Count columns of a cluster's nodes by namespace.
COUNTS = {"n_isbns": "ISBN", "n_loc_recs": "LOC", "n_ol_editions": "OL-E", "n_ol_works": "OL-W", "n_gr_books": "GR-B", "n_gr_works": "GR-W"}


def cluster_stats(clustered: DataFrame, code: str = "book_code", cluster: str = "cluster") -> DataFrame:
    counts = [F.count_if(ids.in_namespace(F.col(code), ns)).alias(name) for name, ns in COUNTS.items()]
    return clustered.groupBy(F.col(cluster).alias("cluster")).agg(F.count("*").alias("n_nodes"), *counts)


def cluster_metrics(stats: DataFrame) -> DataFrame:
    """One row: number of clusters, largest number of nodes, largest number of ISBNs."""
    return stats.agg(F.count("*").alias("clusters"), F.max("n_nodes").alias("largest"), F.max("n_isbns").alias("max_isbns"))


def cluster_hashes(members: DataFrame, cluster: str = "cluster", key: str = "isbn") -> DataFrame:
    """MD5 of each cluster's keys, sorted and joined, and the parity of its last byte; null keys are left out."""
    joined = F.array_join(F.array_sort(F.collect_list(key)), "")
    hashed = members.where(F.col(key).isNotNull()).groupBy(F.col(cluster).alias("cluster")).agg(F.md5(joined).alias("isbn_hash"))
    return hashed.withColumn("isbn_dcode", (F.conv(F.right("isbn_hash", F.lit(2)), 16, 10).cast("int") % 2).cast("byte"))


def extract_books(clustered: DataFrame, namespace: str, name: str = "book_id", extra: DataFrame | None = None, extra_key: str | None = None) -> DataFrame:
    """Records of one namespace with their clusters, and columns of another table where it has the record."""
    out = clustered.where(ids.in_namespace(F.col("book_code"), namespace)).select(ids.from_code(F.col("book_code"), namespace).alias(name), "cluster")
    if extra is None:
        return out
    side = extra.withColumnRenamed(extra_key or name, "_tf_key")
    return out.join(side, F.col(name) == F.col("_tf_key"), "left").drop("_tf_key")


def subgraph(clustered: DataFrame, edges: DataFrame, clusters: list[int]) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of some clusters."""
    nodes = clustered.where(F.col("cluster").isin(clusters))
    codes = nodes.select("book_code")
    inner = edges.join(codes, F.col("src") == F.col("book_code"), "left_semi").join(codes, F.col("dst") == F.col("book_code"), "left_semi")
    return nodes, inner


def distances(edges: DataFrame, start: int) -> DataFrame:
    """Breadth-first ``node, distance`` from a node to all that it reaches; the largest is the node's eccentricity.

    Every step joins only the last front and writes what is new, so a path costs a step for each of its edges.
    """
    from tomeflow.workspace import Workspace

    ws = Workspace(edges.sparkSession, "distances")
    both = ws.stage(edges.select("src", "dst").unionAll(edges.select(F.col("dst"), F.col("src"))).distinct(), "arcs")
    kind = edges.schema["src"].dataType
    front = ws.stage(edges.sparkSession.range(1).select(F.lit(start).cast(kind).alias("node"), F.lit(0).alias("distance")), "front")
    # In breadth-first order a neighbour of a front is in the front before, in it, or new.
    fronts, before, step = [front._staged_path], front, 0
    while not front.isEmpty():
        step += 1
        near = both.join(front.select("node"), both["src"] == front["node"]).select(F.col("dst").alias("node")).distinct()
        new = near.join(front, "node", "left_anti").join(before, "node", "left_anti").withColumn("distance", F.lit(step))
        before, front = front, ws.stage(new, "front")
        fronts.append(front._staged_path)
    return edges.sparkSession.read.schema(front.schema).parquet(*fronts)


def histogram(df: DataFrame, column: str, count: str = "count") -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias(count))


def first_of(column: str, *order: str) -> Column:
    """The value of the least row in an order, as an aggregate."""
    return F.min_by(F.col(column), F.struct(*[F.col(o) for o in order]))
