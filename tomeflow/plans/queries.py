"""The library's operators applied to the driver's tables, each with the SQL that gives the same rows.

The star-schema tables stand in for catalogue and reader data: orders and their lines are
interactions (customer = user, part = item, quantity = rating, ship date = time), orders and
customers are an identifier graph, names and numbers stand in for ISBNs and headings.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tomeflow.functions import dates, gender, ids, isbn, names, text
from tomeflow.operators import authors, graph, index, interactions, kcore, reports, works

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def seconds(c: str) -> Column:
    """Epoch seconds of a timestamp without a zone, whatever the session's zone."""
    t = F.col(c).cast("timestamp_ntz")
    days = F.date_diff(t, F.lit("1970-01-01").cast("date")).cast("long")
    return days * 86400 + F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)


def reading(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interactions: ``user_id, item_id, rating, timestamp, rec``."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate", "l_linenumber", "l_suppkey", "l_extendedprice")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    rec = F.struct(F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_suppkey"), F.col("l_extendedprice"))
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"), F.col("l_quantity").alias("rating"), seconds("l_shipdate").alias("timestamp"), rec.alias("rec")
    )


_READING = """SELECT o_custkey AS user_id, l_partkey AS item_id, l_quantity AS rating, CAST(epoch(l_shipdate) AS BIGINT) AS "timestamp",
        {'o': l_orderkey, 'l': l_linenumber, 's': l_suppkey, 'p': l_extendedprice} AS rec
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


# Interactions


@query(f"""WITH i AS ({_READING})
    SELECT user_id, item_id, median(rating) AS rating, arg_max(rating, {{'t': "timestamp", 'r': rating}}) AS last_rating,
        min("timestamp") AS first_time, max("timestamp") AS last_time, count(*) AS nratings
    FROM i GROUP BY user_id, item_id""")
def cluster_ratings(spark, sf_dir):
    return interactions.cluster_ratings(reading(spark, sf_dir))


@query(f"""WITH i AS ({_READING})
    SELECT user_id, item_id, min("timestamp") AS first_time, max("timestamp") AS last_time, count(*) AS nactions,
        arg_max(rating, {{'t': "timestamp", 'r': rating}}) FILTER (WHERE rating > 25) AS last_rating
    FROM i GROUP BY user_id, item_id""")
def cluster_actions_last_rating(spark, sf_dir):
    rated = reading(spark, sf_dir).withColumn("rating", F.when(F.col("rating") > 25, F.col("rating")))
    return interactions.cluster_actions(rated)


@query(f"""WITH i AS ({_READING})
    SELECT user_id, item_id, median(rating) AS rating, arg_max(rating, {{'t': rec, 'r': rating}}) AS last_rating,
        min("timestamp") AS first_time, max("timestamp") AS last_time, count(*) AS nratings
    FROM i GROUP BY user_id, item_id""")
def feed_order_ratings(spark, sf_dir):
    return interactions.cluster_ratings(reading(spark, sf_dir), order="rec")


@query("""SELECT user_id, event_id, CASE WHEN event_type = 'purchase' THEN 400000000 + event_id ELSE 500000000 + event_id END::INT AS item_id FROM events""")
def native_item_id(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", F.when(F.col("event_type") == "purchase", F.col("event_id")).alias("work_id"))
    return interactions.native_items(e, "work_id", "event_id").select("user_id", "event_id", "item_id")


@query("""SELECT user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS item_id, median(value) AS rating, count(*) AS nratings
    FROM events WHERE value > 0 GROUP BY 1, 2""")
def explicit_ratings(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", F.get_json_object("props", "$.k").cast("long").alias("item_id"), F.col("value").alias("rating"))
    return interactions.cluster_ratings(interactions.explicit_only(e), time=None)


@query(f"""WITH i AS ({_READING}), s AS (
        SELECT user_id, item_id, list_sort(list({{'k': CAST(floor(rating * 10) AS INT), 't': "timestamp", 'r': rating}})) AS s,
            arg_max(rating, {{'t': "timestamp", 'r': rating}}) AS last_rating, count(*) AS n
        FROM i GROUP BY user_id, item_id)
    SELECT user_id, item_id, last_rating, n AS nratings,
        CASE WHEN n % 2 = 1 THEN s[n // 2 + 1].r ELSE (s[n // 2].r + s[n // 2 + 1].r) / 2 END AS rating,
        CASE WHEN n % 2 = 1 THEN s[n // 2 + 1].t ELSE (s[n // 2].t + s[n // 2 + 1].t) // 2 END AS "timestamp"
    FROM s""")
def dedup_median_time(spark, sf_dir):
    return interactions.dedup_with_median_time(reading(spark, sf_dir))


@query("""SELECT o_custkey AS user_id, coalesce(CASE WHEN p_size > 25 THEN 100000000 + p_partkey END, 900000000 + l_partkey)::INT AS item_id,
        median(l_quantity) AS rating, CAST(median(epoch(l_shipdate)) AS BIGINT) AS med_time, count(*) AS nratings
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""")
def legacy_rating_view(spark, sf_dir):
    links = table(spark, sf_dir, "part").where("p_size > 25").select("p_partkey", ids.to_code(F.col("p_partkey"), "OL-W").alias("cluster"))
    kept = interactions.keep_unclustered(reading(spark, sf_dir).withColumnRenamed("item_id", "key"), links, "key", "p_partkey")
    # DuckDB rounds when it casts the median of an even number of times to an integer.
    return kept.groupBy("user_id", "item_id").agg(
        F.median("rating").alias("rating"), F.rint(F.median("timestamp")).cast("long").alias("med_time"), F.count("*").alias("nratings")
    )


@query("""SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""")
def anti_join_orders(spark, sf_dir):
    bad = table(spark, sf_dir, "customer").where("c_acctbal < 0")
    return interactions.without(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_custkey", bad, "c_custkey")


# Identifiers


@query("""WITH k AS (
        SELECT CAST(l_partkey AS VARCHAR) AS key, 'L' AS s FROM lineitem
        UNION ALL SELECT CAST(l_suppkey AS VARCHAR), 'L' FROM lineitem
        UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'P' FROM part
        UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'C' FROM customer)
    SELECT CAST(row_number() OVER (ORDER BY key) AS INT) AS key_id, key, count(*) FILTER (WHERE s = 'L') AS "L",
        count(*) FILTER (WHERE s = 'P') AS "P", count(*) FILTER (WHERE s = 'C') AS "C"
    FROM k GROUP BY key""")
def collect_ids(spark, sf_dir):
    return index.collect_ids(
        {"L": (table(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey"]), "P": (table(spark, sf_dir, "part"), ["p_partkey"]), "C": (table(spark, sf_dir, "customer"), ["c_custkey"])},
        "key", "key_id",
    )


@query("""WITH n AS (SELECT name, CAST(row_number() OVER (ORDER BY name) AS INT) AS name_id FROM (SELECT DISTINCT unnest([p_name, p_brand, p_type]) AS name FROM part)),
    t AS (UNPIVOT (SELECT p_partkey, p_name, p_brand, p_type FROM part) ON p_name, p_brand, p_type INTO NAME field VALUE name)
    SELECT DISTINCT p_partkey, name_id FROM t JOIN n USING (name)""")
def link_ids(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    columns = ["p_name", "p_brand", "p_type"]
    all_names = index.collect_ids({"part": (part, columns)}, "name", "name_id")
    return index.link_ids(part, "p_partkey", columns, all_names, "name", "name_id")


@query("""SELECT event_id, u.id AS user_no FROM events JOIN (
        SELECT user_id, CAST(row_number() OVER (ORDER BY CAST(user_id AS VARCHAR)) AS INT) AS id FROM (SELECT DISTINCT user_id FROM events)) u USING (user_id)""")
def string_index(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", F.col("user_id").cast("string").alias("user"))
    return index.StringIndex.build(e, "user").lookup(e, "user", "user_no", frozen=True).select("event_id", "user_no")


@query("""SELECT code, code - 400000000 AS work_id, 'GR-W' AS namespace FROM (
        SELECT CAST(CASE WHEN event_id % 2 = 0 THEN 400000000 ELSE 500000000 END + event_id AS INT) AS code FROM events) WHERE code // 100000000 = 4""")
def namespace_filter(spark, sf_dir):
    code = (F.when(F.col("event_id") % 2 == 0, ids.base("GR-W")).otherwise(ids.base("GR-B")) + F.col("event_id")).cast("int")
    e = table(spark, sf_dir, "events").select(code.alias("code")).where(ids.in_namespace(F.col("code"), "GR-W"))
    return e.select("code", ids.from_code(F.col("code"), "GR-W").alias("work_id"), ids.namespace_name(F.col("code")).alias("namespace"))


# Graph


def _nodes(spark, sf_dir) -> DataFrame:
    return graph.union_nodes(
        graph.node_source(table(spark, sf_dir, "customer"), "c_custkey", "OL-W", "c_name"),
        graph.node_source(table(spark, sf_dir, "orders"), "o_orderkey", "OL-E"),
        graph.node_source(table(spark, sf_dir, "part"), "p_partkey", "ISBN", "p_name"),
        graph.node_source(table(spark, sf_dir, "nation"), "n_nationkey", "LOC", "n_name"),
    )


def _edges(spark, sf_dir) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_totalprice") > 20000, F.col("o_custkey")).alias("o_custkey"))
    return graph.union_edges(graph.edge_source(orders, "o_orderkey", "OL-E", "o_custkey", "OL-W"))


_NODES = """SELECT book_code, min(label) AS label FROM (
        SELECT CAST(100000000 + c_custkey AS INT) AS book_code, c_name AS label FROM customer
        UNION ALL SELECT CAST(200000000 + o_orderkey AS INT), NULL FROM orders
        UNION ALL SELECT CAST(900000000 + p_partkey AS INT), p_name FROM part
        UNION ALL SELECT CAST(300000000 + n_nationkey AS INT), n_name FROM nation) GROUP BY book_code"""
_EDGES = "SELECT CAST(200000000 + o_orderkey AS INT) AS src, CAST(100000000 + o_custkey AS INT) AS dst FROM orders WHERE o_totalprice > 20000"
_CLUSTERED = f"""n AS ({_NODES}), e AS ({_EDGES}), b AS (SELECT src, dst FROM e UNION SELECT dst, src FROM e),
    r AS (SELECT book_code AS node, book_code AS label FROM n UNION SELECT b.dst, r.label FROM r JOIN b ON r.node = b.src),
    c AS (SELECT node AS book_code, min(r.label) AS cluster FROM r GROUP BY node)"""
_COUNTS = ", ".join(f"count(*) FILTER (WHERE book_code // 100000000 = {ids.NAMESPACES[ns]}) AS {name}" for name, ns in graph.COUNTS.items())


@query(_NODES)
def graph_nodes(spark, sf_dir):
    return _nodes(spark, sf_dir)


@query(_EDGES)
def graph_edges(spark, sf_dir):
    return _edges(spark, sf_dir)


def _clustered(spark, sf_dir) -> DataFrame:
    return graph.cluster_graph(_nodes(spark, sf_dir), _edges(spark, sf_dir))


@query(f"WITH RECURSIVE {_CLUSTERED} SELECT book_code, cluster FROM c")
def components(spark, sf_dir):
    return _clustered(spark, sf_dir).select("book_code", "cluster")


@query("""WITH RECURSIVE e AS (SELECT l_orderkey + 200000000 AS a, l_partkey + 900000000 AS b FROM lineitem UNION SELECT l_partkey + 900000000, l_suppkey + 300000000 FROM lineitem),
    arcs AS MATERIALIZED (SELECT a, b FROM e UNION SELECT b, a FROM e),
    c(node, least) USING KEY (node) AS (
        SELECT a, a FROM arcs
        UNION
        SELECT arcs.b, min(c.least) FROM c JOIN arcs ON c.node = arcs.a JOIN recurring.c AS now ON now.node = arcs.b WHERE c.least < now.least GROUP BY arcs.b)
    SELECT CAST(node AS INT) AS book_code, CAST(least AS INT) AS cluster FROM c""")
def purchase_components(spark, sf_dir):
    """Customers, parts and suppliers linked by whole order lines: one very large component and its hubs."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    edges = graph.union_edges(graph.edge_source(lines, "l_orderkey", "OL-E", "l_partkey", "ISBN"), graph.edge_source(lines, "l_partkey", "ISBN", "l_suppkey", "LOC"))
    nodes = edges.select(F.explode(F.array("src", "dst")).alias("book_code")).distinct().withColumn("label", F.lit(None).cast("string"))
    return graph.cluster_graph(nodes, edges, check=False).select("book_code", "cluster")


@query(f"WITH RECURSIVE {_CLUSTERED} SELECT cluster, count(*) AS n_nodes, {_COUNTS} FROM c GROUP BY cluster")
def cluster_stats(spark, sf_dir):
    return graph.cluster_stats(_clustered(spark, sf_dir))


@query(f"""WITH RECURSIVE {_CLUSTERED}, s AS (SELECT cluster, count(*) AS n_nodes, {_COUNTS} FROM c GROUP BY cluster)
    SELECT count(*) AS clusters, max(n_nodes) AS largest, max(n_isbns) AS max_isbns FROM s""")
def cluster_metrics(spark, sf_dir):
    return graph.cluster_metrics(graph.cluster_stats(_clustered(spark, sf_dir)))


@query("""SELECT o_custkey AS cluster, md5(string_agg(CAST(o_orderkey AS VARCHAR), '' ORDER BY CAST(o_orderkey AS VARCHAR))) AS isbn_hash,
        CAST(instr('0123456789abcdef', md5(string_agg(CAST(o_orderkey AS VARCHAR), '' ORDER BY CAST(o_orderkey AS VARCHAR)))[32]) - 1 AS INT) % 2 AS isbn_dcode
    FROM orders GROUP BY o_custkey""")
def cluster_hash(spark, sf_dir):
    members = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("cluster"), F.col("o_orderkey").cast("string").alias("isbn"))
    return graph.cluster_hashes(members)


@query(f"""WITH RECURSIVE {_CLUSTERED}
    SELECT CAST(c.book_code - 200000000 AS INT) AS edition, cluster, o_orderstatus, o_orderpriority FROM c LEFT JOIN orders ON c.book_code - 200000000 = o_orderkey
    WHERE c.book_code // 100000000 = 2""")
def extract_books_join(spark, sf_dir):
    extra = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return graph.extract_books(_clustered(spark, sf_dir), "OL-E", "edition", extra, "o_orderkey")


@query(f"""WITH RECURSIVE {_CLUSTERED}, k AS (SELECT book_code, cluster FROM c WHERE cluster IN (100000001, 100000007))
    SELECT src, dst, k.cluster FROM e JOIN k ON src = k.book_code""")
def subgraph_edges(spark, sf_dir):
    clustered, edges = _clustered(spark, sf_dir), _edges(spark, sf_dir)
    nodes, inner = graph.subgraph(clustered, edges, [ids.code_of("OL-W", 1), ids.code_of("OL-W", 7)])
    return graph.graph_edges(nodes, inner)


# Authors and genders


#: Some names have several records, most have one.
_NAME = "concat(c_mktsegment, ' ', c_custkey % 499)"


def _pairs(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Clusters (orders' lines), their editions, the editions' authors and the authors' names."""
    lines = table(spark, sf_dir, "lineitem")
    clusters = lines.select(F.col("l_partkey").alias("isbn_id"), ids.to_code(F.col("l_partkey") % 997, "OL-W").alias("cluster")).distinct()
    isbns = lines.select(F.col("l_partkey").alias("isbn_id"), F.col("l_orderkey").alias("edition")).distinct()
    orders = table(spark, sf_dir, "orders")
    edition_authors = orders.select(F.col("o_orderkey").alias("edition"), F.when(F.col("o_orderstatus") == "F", 0).otherwise(1).alias("pos"), F.col("o_custkey").alias("author"))
    names_ = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.expr(_NAME).alias("name"))
    return clusters, isbns, edition_authors, names_


_AUTHORS = """a AS (
        SELECT DISTINCT CAST(100000000 + l_partkey % 997 AS INT) AS cluster, c_mktsegment || ' ' || (c_custkey % 499) AS author_name
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'F'
        UNION SELECT CAST(900000000 + p_size AS INT), p_type FROM part WHERE p_type <> '' AND p_size < 10)"""


def _cluster_authors(spark, sf_dir) -> DataFrame:
    clusters, isbns, edition_authors, names_ = _pairs(spark, sf_dir)
    # Larger books have no author.
    books = table(spark, sf_dir, "part").select(ids.to_code(F.col("p_size"), "ISBN").alias("cluster"), F.when(F.col("p_size") < 10, F.col("p_type")).alias("author_name"))
    return authors.cluster_authors(authors.edition_authors(clusters, isbns, edition_authors, names_, first_only=True), books, clean=False)


@query(f"WITH {_AUTHORS} SELECT cluster, author_name FROM a")
def first_authors_union(spark, sf_dir):
    return _cluster_authors(spark, sf_dir)


def _name_index(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    headings = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("rec_id"), F.expr(_NAME).alias("name"))
    genders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("rec_id"), F.when(F.col("o_orderkey") % 40 == 0, " Female").when(F.col("o_orderkey") % 40 == 1, "male ").otherwise("unknown").alias("gender")
    )
    return headings, genders


_GENDERS = """g AS (
        SELECT o_custkey AS rec_id, CASE o_orderkey % 40 WHEN 0 THEN 'female' WHEN 1 THEN 'male' ELSE 'unknown' END AS gender FROM orders),
    rg AS (SELECT rec_id, CASE WHEN count(DISTINCT gender) FILTER (WHERE gender <> 'unknown') > 1 THEN 'ambiguous'
            ELSE coalesce(max(gender) FILTER (WHERE gender <> 'unknown'), 'unknown') END AS gender FROM g GROUP BY rec_id),
    t AS (SELECT c_mktsegment || ' ' || (c_custkey % 499) AS name, count(*) AS n_author_recs,
            CASE WHEN count(DISTINCT gender) FILTER (WHERE gender <> 'unknown') > 1 THEN 'ambiguous'
                WHEN count(gender) = 0 THEN NULL ELSE coalesce(max(gender) FILTER (WHERE gender <> 'unknown'), 'unknown') END AS gender
        FROM customer LEFT JOIN rg ON c_custkey = rec_id GROUP BY 1)"""


@query(f"WITH {_GENDERS} SELECT rec_id, gender FROM rg")
def gender_bag(spark, sf_dir):
    return authors.record_genders(_name_index(spark, sf_dir)[1])


@query(f"WITH {_GENDERS} SELECT name, n_author_recs, gender FROM t")
def author_name_table(spark, sf_dir):
    return authors.name_table(*_name_index(spark, sf_dir))


_STATUS = f"""{_AUTHORS}, {_GENDERS},
    k AS (SELECT DISTINCT CAST(100000000 + l_partkey % 997 AS INT) AS cluster FROM lineitem UNION SELECT CAST(900000000 + p_size AS INT) FROM part UNION SELECT CAST(300000000 + n_nationkey AS INT) FROM nation),
    b AS (SELECT cluster, count(*) AS n, coalesce(sum(n_author_recs), 0) AS r,
            CASE WHEN count(DISTINCT gender) FILTER (WHERE gender <> 'unknown') > 1 THEN 'ambiguous'
                WHEN count(gender) = 0 THEN NULL ELSE coalesce(max(gender) FILTER (WHERE gender <> 'unknown'), 'unknown') END AS gender
        FROM a LEFT JOIN t ON a.author_name = t.name GROUP BY cluster),
    cg AS (SELECT k.cluster, CASE WHEN b.n IS NULL THEN CASE WHEN k.cluster // 100000000 = 9 THEN 'no-book' ELSE 'no-book-author' END
            WHEN b.r = 0 THEN 'no-author-rec' WHEN b.gender IS NULL THEN 'no-gender' ELSE b.gender END AS gender FROM k LEFT JOIN b USING (cluster))"""


def _cluster_genders(spark, sf_dir) -> DataFrame:
    clusters = (
        table(spark, sf_dir, "lineitem").select(ids.to_code(F.col("l_partkey") % 997, "OL-W").alias("cluster"))
        .unionAll(table(spark, sf_dir, "part").select(ids.to_code(F.col("p_size"), "ISBN")))
        .unionAll(table(spark, sf_dir, "nation").select(ids.to_code(F.col("n_nationkey"), "LOC")))
    )
    return authors.cluster_genders(clusters, _cluster_authors(spark, sf_dir), authors.name_table(*_name_index(spark, sf_dir)))


@query(f"WITH {_STATUS} SELECT cluster, gender FROM cg")
def cluster_gender_status(spark, sf_dir):
    return _cluster_genders(spark, sf_dir)


_STATS = f"""{_STATUS}, st AS (
        SELECT 'LOC-MDS' AS dataset, gender, count(DISTINCT cluster) AS n_books, NULL::BIGINT AS n_actions
        FROM (SELECT DISTINCT CAST(100000000 + l_partkey % 997 AS INT) AS cluster FROM lineitem) JOIN cg USING (cluster) GROUP BY gender
        UNION ALL SELECT 'LINES', gender, count(DISTINCT cluster), count(*) FROM (SELECT CAST(100000000 + l_partkey % 997 AS INT) AS cluster FROM lineitem) JOIN cg USING (cluster) GROUP BY gender
        UNION ALL SELECT 'PARTS', gender, count(DISTINCT cluster), count(*) FROM (SELECT CAST(900000000 + p_size AS INT) AS cluster FROM part) JOIN cg USING (cluster) GROUP BY gender)"""


def _stats(spark, sf_dir) -> DataFrame:
    genders = _cluster_genders(spark, sf_dir)
    lines = table(spark, sf_dir, "lineitem").select(ids.to_code(F.col("l_partkey") % 997, "OL-W").alias("item_id"))
    parts = table(spark, sf_dir, "part").select(ids.to_code(F.col("p_size"), "ISBN").alias("item_id"))
    return reports.integration_stats(
        [reports.gender_coverage("LOC-MDS", lines, genders, actions=False), reports.gender_coverage("LINES", lines, genders), reports.gender_coverage("PARTS", parts, genders)]
    )


@query(f"WITH {_STATS} SELECT dataset, gender, n_books, n_actions FROM st")
def integration_stats(spark, sf_dir):
    return _stats(spark, sf_dir)


_GENDER_COLUMNS = reports.RESOLVED + reports.UNLINKED
_PIVOT = "SELECT dataset, " + ", ".join(f"CAST(sum(n_books) FILTER (WHERE gender = '{g}') AS BIGINT) AS \"{g}\"" for g in _GENDER_COLUMNS) + " FROM st GROUP BY dataset"


@query(f"WITH {_STATS} {_PIVOT}")
def linkage_pivot(spark, sf_dir):
    return reports.pivot_counts(_stats(spark, sf_dir), "n_books")


_Z = {g: f'coalesce("{g}", 0)' for g in _GENDER_COLUMNS}
_UNLINKED = " + ".join(_Z[g] for g in reports.UNLINKED)
_TOTAL = " + ".join(_Z.values())


@query(f"""WITH {_STATS}, p AS ({_PIVOT}) SELECT dataset, {", ".join(f'CAST({_Z[g]} AS DOUBLE) / nullif({_TOTAL}, 0) AS "{g}"' for g in reports.RESOLVED)},
    CAST({_UNLINKED} AS DOUBLE) / nullif({_TOTAL}, 0) AS unlinked FROM p""")
def fractionalize(spark, sf_dir):
    return reports.fractionalize(reports.pivot_counts(_stats(spark, sf_dir), "n_books"), "dataset", reports.RESOLVED, reports.UNLINKED)


@query(f"""WITH {_STATS}, p AS ({_PIVOT}) SELECT dataset, CAST({_Z["male"]} + {_Z["female"]} + {_Z["ambiguous"]} AS DOUBLE) / nullif({_TOTAL}, 0) AS coverage FROM p""")
def coverage(spark, sf_dir):
    return reports.coverage(reports.pivot_counts(_stats(spark, sf_dir), "n_books"))


# k-core


def _core_sql(source: str, user_k: int, item_k: int, rounds: int) -> str:
    steps = [f"p0 AS ({source})"]
    for r in range(rounds):
        steps.append(f"q{r} AS (SELECT * FROM p{r} WHERE i IN (SELECT i FROM p{r} GROUP BY i HAVING count(*) >= {item_k}))")
        steps.append(f"p{r + 1} AS (SELECT * FROM q{r} WHERE u IN (SELECT u FROM q{r} GROUP BY u HAVING count(*) >= {user_k}))")
    return f"WITH {', '.join(s.replace(' AS (', ' AS MATERIALIZED (', 1) for s in steps)} SELECT u AS user_id, i AS item_id FROM p{rounds}"


_DISTINCT_PAIRS = "SELECT DISTINCT o_custkey AS u, l_partkey AS i FROM lineitem JOIN orders ON l_orderkey = o_orderkey"


def _distinct_pairs(spark, sf_dir) -> DataFrame:
    return reading(spark, sf_dir).groupBy("user_id", "item_id").agg(F.min("timestamp").alias("first_time"))


@query(_core_sql(_DISTINCT_PAIRS, 20, 25, 16))
def kcore_ku_ki(spark, sf_dir):
    return kcore.kcore(_distinct_pairs(spark, sf_dir), 20, 25).select("user_id", "item_id")


@query(_core_sql(_DISTINCT_PAIRS, 5, 5, 6))
def kcore_five(spark, sf_dir):
    return kcore.kcore(_distinct_pairs(spark, sf_dir), 5, 5).select("user_id", "item_id")


@query(_core_sql("SELECT o_custkey AS u, l_partkey AS i FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2 HAVING min(epoch(l_shipdate)) >= 883612800 AND min(epoch(l_shipdate)) < 915148800", 3, 3, 20))
def kcore_year(spark, sf_dir):
    return kcore.kcore(kcore.time_range(_distinct_pairs(spark, sf_dir), *dates.year_range(1998)), 3, 3).select("user_id", "item_id")


# Scalar functions


@query("""SELECT c_custkey, regexp_replace(translate(c_name || ' xO-' || c_acctbal, 'xO', 'X0'), '[^0-9X]', '', 'g') AS isbn,
        upper(regexp_replace(c_name || '-' || c_mktsegment, '[^0-9A-Za-z]', '', 'g')) AS asin,
        regexp_replace(upper(c_name || ' x O'), '[^0-9X]', '', 'g') AS rating_isbn FROM customer""")
def isbn_clean(spark, sf_dir):
    name = F.col("c_name")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        isbn.clean_isbn(F.concat(name, F.lit(" xO-"), F.col("c_acctbal").cast("string"))).alias("isbn"),
        isbn.clean_asin(F.concat(name, F.lit("-"), F.col("c_mktsegment"))).alias("asin"),
        isbn.clean_rating_isbn(F.concat(name, F.lit(" x O"))).alias("rating_isbn"),
    )


@query("""SELECT p_partkey, n AS place, lpad(CAST(p_partkey * 7 + n AS VARCHAR), 9, '9') || '0' AS isbn, CASE n WHEN 0 THEN 'pbk.' ELSE 'set' END AS tag
    FROM part, (SELECT unnest([0, 1]) AS n)""")
def isbn_parse(spark, sf_dir):
    number = lambda n: F.lpad((F.col("p_partkey") * 7 + n).cast("string"), 9, "9")
    field = F.concat(number(0), F.lit("0 (pbk.) ; ISBN "), number(1), F.lit("0 [set] : $5.00"))
    found = table(spark, sf_dir, "part").select("p_partkey", F.posexplode(isbn.parse_isbns(field)).alias("place", "x"))
    return found.select("p_partkey", "place", F.col("x.isbn").alias("isbn"), F.explode("x.tags").alias("tag"))


@query("""SELECT p_partkey, trim(replace(regexp_replace(p_name || '.  ' || p_type || ' , ' || p_brand || '.', '[ \\t\\n\\f\\r.]+', ' ', 'g'), ' ,', ',')) AS name,
        p_type || ' ' || p_brand AS plain FROM part""")
def name_clean(spark, sf_dir):
    messy = F.concat("p_name", F.lit(".  "), "p_type", F.lit(" , "), "p_brand", F.lit("."))
    plain = F.concat(F.lit("  "), "p_type", F.lit(" "), "p_brand", F.lit("　"))
    return table(spark, sf_dir, "part").select("p_partkey", text.clean_name(messy).alias("name"), text.clean_name(plain).alias("plain"))


@query("""SELECT DISTINCT name, c_custkey AS rec_id FROM (
        SELECT c_custkey, unnest(['Jr ' || c_mktsegment || ' Smith' || c_nationkey, 'Smith' || c_nationkey || ', Jr ' || c_mktsegment,
            'Jr ' || c_mktsegment || ' Smith' || c_nationkey || ', 19' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || '-',
            'Smith' || c_nationkey || ', Jr ' || c_mktsegment || ', 19' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || '-']) AS name FROM customer)""")
def name_variants(spark, sf_dir):
    nation = F.col("c_nationkey").cast("string")
    heading = F.concat(F.lit("Smith"), nation, F.lit(", Jr. "), "c_mktsegment", F.lit(", 19"), F.lpad(nation, 2, "0"), F.lit("-."))
    return names.index_names(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("rec_id"), heading.alias("contents")))


@query("SELECT o_orderkey, CAST(o_orderkey AS INT) AS work, CAST(o_custkey AS INT) AS author FROM orders")
def ol_key(spark, sf_dir):
    work = F.concat(F.lit("/works/OL"), F.col("o_orderkey").cast("string"), F.lit("W"))
    author = F.concat(F.lit("/a/OL"), F.col("o_custkey").cast("string"), F.lit("A"))
    return table(spark, sf_dir, "orders").select("o_orderkey", ids.parse_key(work, "works").alias("work"), ids.parse_key(author, "authors").alias("author"))


@query("""SELECT event_id, xor(CAST(CASE WHEN a[1] >= '8' THEN CAST(('0x' || a)::UBIGINT AS HUGEINT) - 18446744073709551616 ELSE ('0x' || a)::UBIGINT END AS BIGINT),
            CAST(CASE WHEN b[1] >= '8' THEN CAST(('0x' || b)::UBIGINT AS HUGEINT) - 18446744073709551616 ELSE ('0x' || b)::UBIGINT END AS BIGINT)) AS review_id
    FROM (SELECT event_id, md5(CAST(event_id AS VARCHAR))[1:16] AS a, md5(CAST(event_id AS VARCHAR))[17:32] AS b FROM events)""")
def hex_xor(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", ids.hex_xor(F.md5(F.col("event_id").cast("string"))).alias("review_id"))


@query("""SELECT o_orderkey, CAST(epoch(o_orderdate) AS BIGINT) + 37 + 3600 * 7 AS seconds, CAST(CAST(CAST(epoch(o_orderdate) AS BIGINT) + 37 + 3600 * 7 AS FLOAT) AS BIGINT) AS added FROM orders""")
def feed_dates(spark, sf_dir):
    day = F.date_format(F.col("o_orderdate").cast("timestamp_ntz"), "EEE MMM dd")
    written = F.concat(day, F.lit(" 00:00:37 -0700 "), F.year("o_orderdate").cast("string"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.unix_timestamp(dates.parse_feed_date(written)).alias("seconds"), dates.feed_seconds(written).cast("long").alias("added")
    )


@query("""SELECT event_id, key, CAST(json_extract(props, '$.' || key) AS INT) AS count FROM (SELECT event_id, props, unnest(json_keys(props)) AS key FROM events)""")
def json_map(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", F.from_json("props", "map<string,int>").alias("m"))
    return e.select("event_id", F.explode("m").alias("key", "count"))


@query("""SELECT event_id, CASE event_id % 4 WHEN 3 THEN NULL ELSE CAST(event_id AS INT) END AS author FROM events""")
def json_union(spark, sf_dir):
    from tomeflow.sources.openlibrary import reference_key

    number = F.col("event_id").cast("string")
    key = F.concat(F.lit('"/authors/OL'), number, F.lit('A"'))
    forms = (
        F.when(F.col("event_id") % 4 == 0, F.concat(F.lit('{"key": '), key, F.lit("}")))
        .when(F.col("event_id") % 4 == 1, F.concat(F.lit('{"type": "x", "author": {"key": '), key, F.lit("}}")))
        .when(F.col("event_id") % 4 == 2, key)
        .otherwise(F.lit("{}"))
    )
    parsed = table(spark, sf_dir, "events").select("event_id", F.parse_json(forms).alias("v"))
    return parsed.select("event_id", ids.parse_key(reference_key(F.col("v")), "authors").alias("author"))


@query("SELECT c_custkey, c_name[1:8] AS head, c_name[10:] AS tail, lower(c_mktsegment) AS gender FROM customer")
def split_fields(spark, sf_dir):
    head, tail = text.split_first(F.col("c_name"), "#")
    gendered = gender.parse_gender(F.concat(F.lit(" "), "c_mktsegment", F.lit(" ")))
    return table(spark, sf_dir, "customer").select("c_custkey", head.alias("head"), tail.alias("tail"), gendered.alias("gender"))


# Works


def _book_ids(spark, sf_dir) -> DataFrame:
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("book_id"), F.when(F.col("p_size") <= 40, F.col("p_partkey") % 1009).alias("work_id"), "p_name", "p_type", "p_size", "p_brand")
    return interactions.native_items(part)


_BOOK_IDS = """bi AS (SELECT p_partkey AS book_id, CASE WHEN p_size <= 40 THEN p_partkey % 1009 END AS work_id,
        CAST(CASE WHEN p_size <= 40 THEN 400000000 + p_partkey % 1009 ELSE 500000000 + p_partkey END AS INT) AS item_id, p_name, p_type, p_size, p_brand FROM part)"""


@query(f"""WITH {_BOOK_IDS} SELECT DISTINCT item_id, work_id::INT AS work_id, NULL::INT AS book_id, c_name AS title FROM bi LEFT JOIN customer ON work_id = c_custkey WHERE work_id IS NOT NULL
    UNION ALL SELECT item_id, NULL, book_id::INT, p_name FROM bi WHERE work_id IS NULL""")
def item_titles(spark, sf_dir):
    books = _book_ids(spark, sf_dir).withColumns({c: F.col(c).cast("int") for c in ("book_id", "work_id")})
    info = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("int").alias("book_id"), F.col("p_name").alias("title"))
    work_info = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("int").alias("work_id"), F.col("c_name").alias("title"))
    return works.item_titles(books, info, work_info)


@query(f"""WITH {_BOOK_IDS} SELECT item_id, l_linenumber AS genre_id, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS count FROM bi JOIN lineitem ON book_id = l_partkey GROUP BY 1, 2""")
def item_genres(spark, sf_dir):
    genres = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("book_id"), F.col("l_linenumber").alias("genre_id"), F.col("l_quantity").cast("long").alias("count"))
    return works.item_genres(_book_ids(spark, sf_dir), genres)


def _book_authors(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    lines = table(spark, sf_dir, "lineitem")
    role = F.when(F.col("l_returnflag") == "R", "Editor")
    book_authors = lines.select(F.col("l_partkey").alias("book_id"), F.col("l_suppkey").alias("author_id"), F.col("l_linenumber").alias("position"), role.alias("role"))
    info = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("author_id"), F.when(F.col("s_acctbal") > 0, F.col("s_name")).alias("name"))
    return book_authors, info


@query(f"""WITH {_BOOK_IDS} SELECT DISTINCT item_id, l_suppkey AS author_id, CASE WHEN s_acctbal > 0 THEN s_name END AS author_name FROM bi JOIN lineitem ON book_id = l_partkey
    LEFT JOIN supplier ON l_suppkey = s_suppkey""")
def item_authors(spark, sf_dir):
    return works.item_authors(_book_ids(spark, sf_dir), *_book_authors(spark, sf_dir))


@query(f"""WITH {_BOOK_IDS}, fa AS (SELECT l_partkey AS book_id, arg_min(l_suppkey, {{'p': l_linenumber, 'a': l_suppkey}}) AS author_id FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1)
    SELECT DISTINCT item_id, author_id, CASE WHEN s_acctbal > 0 THEN s_name END AS author_name FROM bi JOIN fa USING (book_id) LEFT JOIN supplier ON author_id = s_suppkey""")
def item_first_authors(spark, sf_dir):
    return works.item_authors(_book_ids(spark, sf_dir), *_book_authors(spark, sf_dir), first_only=True)


def _shelf(spark, sf_dir) -> DataFrame:
    added = seconds("l_shipdate")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("user_id"), F.col("l_partkey").alias("book_id"), F.col("l_linenumber").alias("rec_id"), F.col("l_quantity").alias("rating"),
        (F.col("l_returnflag") == "N").alias("is_read"), added.alias("added"), (added + 86400).alias("updated"),
    )


@query(f"""WITH {_BOOK_IDS} SELECT l_orderkey AS user_id, item_id, book_id, work_id, l_quantity AS rating, l_returnflag = 'N' AS is_read,
        CAST(epoch(l_shipdate) AS BIGINT) AS "timestamp", CAST(epoch(l_shipdate) AS BIGINT) + 86400 AS updated FROM lineitem JOIN bi ON l_partkey = book_id""")
def all_actions(spark, sf_dir):
    return works.all_actions(_shelf(spark, sf_dir), _book_ids(spark, sf_dir))


@query(f"""WITH {_BOOK_IDS} SELECT item_id, arg_min(gender, cluster) AS gender FROM (
        SELECT DISTINCT item_id, p_size AS cluster FROM bi) JOIN (SELECT n_nationkey AS cluster, n_name AS gender FROM nation) USING (cluster) GROUP BY item_id""")
def work_gender_items(spark, sf_dir):
    links = _book_ids(spark, sf_dir).select("book_id", "work_id", F.col("p_size").alias("cluster"))
    return works.work_genders(links, table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("cluster"), F.col("n_name").alias("gender")))


@query(f"""WITH {_BOOK_IDS}, info AS (SELECT book_id, work_id, CAST(1990 + p_size % 25 AS INT) AS pub_year, CAST(book_id % 12 + 1 AS INT) AS pub_month FROM bi),
    st AS (SELECT work_id, count(l_linenumber) AS n_shelves, count(DISTINCT l_orderkey) AS n_users, count(*) FILTER (WHERE l_quantity > 10) AS n_rates,
            count(*) FILTER (WHERE l_quantity - 10 > 2) AS n_pos_rates, sum(l_quantity - 10) FILTER (WHERE l_quantity > 10) / count(*) FILTER (WHERE l_quantity > 10) AS mean_rate
        FROM lineitem JOIN bi ON l_partkey = book_id GROUP BY work_id),
    yr AS (SELECT work_id, min(pub_year) AS pub_year FROM info GROUP BY work_id),
    wr AS (SELECT l_suppkey AS author_id, info.* FROM lineitem JOIN info ON l_partkey = book_id),
    fw AS (SELECT author_id, arg_min_null(work_id, {{'y': pub_year, 'm': pub_month, 'w': coalesce(work_id, -1)}}) AS work_id FROM wr GROUP BY author_id),
    nb AS (SELECT author_id, count(DISTINCT work_id) AS au_nbooks FROM wr GROUP BY author_id)
    SELECT work_id, n_shelves, n_users, n_rates, n_pos_rates, round(mean_rate, 6) AS mean_rate, pub_year, author_id, au_nbooks
    FROM st JOIN yr USING (work_id) JOIN fw USING (work_id) JOIN nb USING (author_id) WHERE pub_year BETWEEN 1990 AND 2012""")
def first_books(spark, sf_dir):
    books = _book_ids(spark, sf_dir)
    info = books.select("book_id", (F.lit(1990) + F.col("p_size") % 25).cast("int").alias("pub_year"), (F.col("book_id") % 12 + 1).cast("int").alias("pub_month"))
    shelf = _shelf(spark, sf_dir).withColumn("rating", F.col("rating") - 10)
    out = works.first_books(shelf, books.select("book_id", "work_id"), info, _book_authors(spark, sf_dir)[0], (1990, 2012))
    return out.withColumn("mean_rate", F.round("mean_rate", 6))


@query(f"""WITH {_BOOK_IDS}, g AS (SELECT item_id, l_returnflag AS genre, count(*) AS n FROM bi JOIN lineitem ON book_id = l_partkey GROUP BY 1, 2)
    SELECT item_id, CAST(coalesce(sum(n) FILTER (WHERE genre = 'A'), 0) AS BIGINT) AS "A", CAST(coalesce(sum(n) FILTER (WHERE genre = 'N'), 0) AS BIGINT) AS "N",
        CAST(coalesce(sum(n) FILTER (WHERE genre = 'R'), 0) AS BIGINT) AS "R" FROM g GROUP BY item_id""")
def dataset_genres(spark, sf_dir):
    books = _book_ids(spark, sf_dir)
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("book_id"), "l_returnflag")
    genres = spark.createDataFrame([(1, "A"), (2, "N"), (3, "R")], "genre_id int, genre string")
    counts = lines.join(F.broadcast(genres), F.col("l_returnflag") == F.col("genre")).groupBy("book_id", "genre_id").agg(F.count("*").alias("count"))
    item_genres_ = works.item_genres(books, counts)
    actions = works.all_actions(_shelf(spark, sf_dir), books).select("item_id", F.col("timestamp").alias("first_time"))
    titles = books.select("item_id", "work_id", "book_id", F.col("p_name").alias("title"))
    return works.recommender_dataset(actions, genres, item_genres_, titles)["genres"]


# Reports


@query("SELECT size, count(*) AS count FROM (SELECT o_custkey, count(*) AS size FROM orders GROUP BY 1) GROUP BY size")
def size_hist(spark, sf_dir):
    return reports.size_histogram(table(spark, sf_dir, "orders"), "o_custkey")


@query("SELECT size, count, sum(count) OVER (ORDER BY size) / sum(count) OVER () AS cum_frac FROM (SELECT size, count(*) AS count FROM (SELECT o_custkey, count(*) AS size FROM orders GROUP BY 1) GROUP BY size)")
def cum_frac(spark, sf_dir):
    return reports.cumulative_fraction(size_hist(spark, sf_dir), "size")


@query(f"""WITH RECURSIVE {_CLUSTERED}, s AS (SELECT cluster, {_COUNTS} FROM c GROUP BY cluster)
    SELECT {", ".join(f"count(*) FILTER (WHERE {c} > 0) AS {c}" for c in graph.COUNTS)} FROM s""")
def src_counts(spark, sf_dir):
    return reports.sources_present(graph.cluster_stats(_clustered(spark, sf_dir)), list(graph.COUNTS))


@query("SELECT o_custkey AS cluster, count(*) AS n_nodes FROM orders GROUP BY 1 ORDER BY n_nodes DESC, cluster LIMIT 10")
def top_clusters(spark, sf_dir):
    counts = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("cluster")).agg(F.count("*").alias("n_nodes"))
    return reports.top(counts, 10, "n_nodes", "cluster")


@query("""SELECT count(n) AS count, round(avg(n), 6) AS mean, round(stddev(n), 6) AS std, min(n) AS min, quantile_cont(n, 0.25) AS q25, quantile_cont(n, 0.5) AS q50, quantile_cont(n, 0.75) AS q75, max(n) AS max
    FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey)""")
def describe_sizes(spark, sf_dir):
    counts = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    return reports.describe(counts, "n").withColumns({c: F.round(c, 6) for c in ("mean", "std")})


def _versions(spark, sf_dir) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    column = lambda keep, value: F.when(keep, value)
    key = F.col("o_orderkey")
    return orders.select(
        key.alias("isbn_id"),
        column(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("v1"),
        column(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey") - F.col("o_custkey") % F.when(F.col("o_orderstatus") == "F", 3).otherwise(1)).alias("v2"),
        (F.col("o_custkey") - F.col("o_custkey") % 3).alias("v3"),
    )


_VERSIONS = """w AS (SELECT o_orderkey AS isbn_id, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS v1,
        CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey - o_custkey % CASE WHEN o_orderstatus = 'F' THEN 3 ELSE 1 END END AS v2, o_custkey - o_custkey % 3 AS v3 FROM orders)"""
_CHANGE = "CASE WHEN {a} IS NULL AND {b} IS NOT NULL THEN 'added' WHEN {a} IS NOT NULL AND {b} IS NULL THEN 'dropped' WHEN {a} <> {b} THEN 'changed' ELSE 'same' END"


@query(f"""WITH {_VERSIONS}, t AS (UNPIVOT (SELECT isbn_id, v1, v2, v3 FROM w) ON v1, v2, v3 INTO NAME version VALUE cluster),
    s AS (SELECT version, cluster, count(*) AS size FROM t GROUP BY 1, 2)
    SELECT version, CAST(sum(size) AS BIGINT) AS n_isbns, count(cluster) AS n_clusters, max(size) AS max_size FROM s GROUP BY version""")
def version_unpivot(spark, sf_dir):
    tall = reports.version_rows(_versions(spark, sf_dir), ["isbn_id"], ["v1", "v2", "v3"])
    return reports.version_metrics(reports.version_sizes(tall))


@query(f"""WITH {_VERSIONS}, c AS (SELECT {_CHANGE.format(a="v1", b="v2")} AS v2, {_CHANGE.format(a="v2", b="v3")} AS v3 FROM w), n AS (SELECT v2, v3, count(*) AS count FROM c GROUP BY 1, 2)
    SELECT v2, v3, count, count / sum(count) OVER () AS fraction, sum(count) OVER (ORDER BY count DESC, v2, v3 ROWS UNBOUNDED PRECEDING) / sum(count) OVER () AS cum_frac FROM n""")
def version_changes(spark, sf_dir):
    return reports.trajectories(_versions(spark, sf_dir), ["v1", "v2", "v3"])


@query(f"""WITH {_VERSIONS}, c AS (SELECT unnest([{{'v': 'v2', 's': {_CHANGE.format(a="v1", b="v2")}}}, {{'v': 'v3', 's': {_CHANGE.format(a="v2", b="v3")}}}]) AS x FROM w)
    SELECT x.v AS version, count(*) FILTER (WHERE x.s = 'added') AS new_isbns, count(*) FILTER (WHERE x.s = 'dropped') AS dropped_isbns, count(*) FILTER (WHERE x.s = 'changed') AS changed_isbns FROM c GROUP BY 1""")
def version_change_counts(spark, sf_dir):
    return reports.changes_by_version(_versions(spark, sf_dir), ["v1", "v2", "v3"])


@query("""SELECT coalesce(a.k, b.k) AS cluster, a.g AS v1, b.g AS v2 FROM (SELECT c_custkey AS k, c_mktsegment AS g FROM customer) a
    FULL JOIN (SELECT s_suppkey * 20 AS k, CASE WHEN s_acctbal > 5000 THEN 'RICH' ELSE 'POOR' END AS g FROM supplier) b ON a.k = b.k""")
def join_versions(spark, sf_dir):
    a = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("cluster"), F.col("c_mktsegment").alias("g"))
    b = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") * 20).alias("cluster"), F.when(F.col("s_acctbal") > 5000, "RICH").otherwise("POOR").alias("g"))
    return reports.join_versions({"v1": a, "v2": b}, "cluster", "g")


@query("""SELECT o_orderstatus, count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS "1-URGENT", count(*) FILTER (WHERE o_orderpriority = '2-HIGH') AS "2-HIGH",
        count(*) FILTER (WHERE o_orderpriority = '3-MEDIUM') AS "3-MEDIUM", count(*) FILTER (WHERE o_orderpriority = '4-NOT SPECIFIED') AS "4-NOT SPECIFIED",
        count(*) FILTER (WHERE o_orderpriority = '5-LOW') AS "5-LOW" FROM orders GROUP BY 1""")
def gender_crosstab(spark, sf_dir):
    return reports.crosstab(table(spark, sf_dir, "orders"), "o_orderstatus", "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"])


# Catalogue records


def _marc(spark, sf_dir) -> DataFrame:
    """A delimited catalogue record for every part."""
    p = lambda c: F.col(c).cast("string")
    xml = F.concat(
        F.lit('<m:record xmlns:m="http://www.loc.gov/MARC21/slim"><m:leader>00000nam a22</m:leader><m:controlfield tag="001"> '), p("p_partkey"),
        F.lit(' </m:controlfield><m:datafield tag="020" ind1=" " ind2="1"><m:subfield code="a">'), F.lpad(p("p_partkey"), 9, "1"),
        F.lit('X (pbk.)</m:subfield></m:datafield><m:datafield tag="375" ind1=" " ind2=" "><m:subfield code="a"> '), p("p_type"),
        F.lit(" &amp; Co </m:subfield><m:subfield code='2'>x</m:subfield></m:datafield></m:record>"),
    )
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("rec_id"), xml.alias("xml"))


@query("""SELECT p_partkey AS rec_id, f.* FROM part, LATERAL (VALUES
        (0, -1, 0, 0, 0, '00000nam a22'), (1, 1, 0, 0, 0, ' ' || p_partkey || ' '), (2, 20, 32, 49, 97, lpad(CAST(p_partkey AS VARCHAR), 9, '1') || 'X (pbk.)'),
        (3, 375, 32, 32, 97, ' ' || p_type || ' & Co '), (4, 375, 32, 32, 50, 'x')) AS f(fld_no, tag, ind1, ind2, sf_code, contents)""")
def marc_flatten(spark, sf_dir):
    from tomeflow.sources import marc

    return marc.flat_fields(marc.parse_records(_marc(spark, sf_dir)))


@query("SELECT p_partkey AS rec_id, lower(p_type) || ' & co' AS gender FROM part")
def marc_filter(spark, sf_dir):
    from tomeflow.sources import marc

    fields = marc.flat_fields(marc.parse_records(_marc(spark, sf_dir)))
    return marc.filter_fields(fields, tag=375, subfield="a", trim=True, lower=True, name="gender")


def entry(spark: SparkSession) -> DataFrame:
    """Ratings of (user, item) pairs: the flagship query."""
    return cluster_ratings(spark, "/root/testdata/sf0.001")
