"""Graph, k-core, index and aggregation operators against brute force on small fixtures."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tomeflow.functions import ids
from tomeflow.operators import authors, checks, components, graph, index, interactions, kcore, reports, works


def union_find(nodes, edges):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("seed,edges", [(1, 90), (2, 140), (3, 260)])
def test_components_of_random_graphs(spark, seed, edges):
    rng = random.Random(seed)
    pairs = [(rng.randrange(200), rng.randrange(200)) for _ in range(edges)]
    df = spark.createDataFrame(pairs + [(7, None)], "src long, dst long")
    nodes = spark.range(200).withColumnRenamed("id", "node")
    got = {r.node: r.component for r in components.label_nodes(nodes, df).collect()}
    assert got == union_find(range(200), pairs)


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(60)]
    star = [(1000, 1001 + i) for i in range(300)]
    df = spark.createDataFrame(path + star, "src long, dst long")
    got = {r.node: r.component for r in components.connected_components(df).collect()}
    assert {got[i] for i in range(61)} == {0} and {got[1000 + i] for i in range(301)} == {1000}
    assert components.connected_components(df.limit(0)).count() == 0


def core(pairs, ku, ki):
    pairs = list(pairs)
    while True:
        items = Counter(i for _, i in pairs)
        kept = [(u, i) for u, i in pairs if items[i] >= ki]
        users = Counter(u for u, _ in kept)
        kept = [(u, i) for u, i in kept if users[u] >= ku]
        if len(kept) == len(pairs):
            return sorted(kept)
        pairs = kept


@pytest.mark.parametrize("ku,ki", [(2, 2), (3, 2), (2, 4), (1, 1), (50, 50)])
def test_kcore(spark, ku, ki):
    rng = random.Random(5)
    pairs = [(rng.randrange(40), int(rng.paretovariate(0.7)) % 60) for _ in range(300)] + [(100 + i, 100 + i) for i in range(5)] + [(100 + i, 101 + i) for i in range(5)]
    df = spark.createDataFrame([(u, i, "x") for u, i in pairs], "user_id int, item_id int, u string")
    assert sorted((r.user_id, r.item_id) for r in kcore.kcore(df, ku, ki).collect()) == core(pairs, ku, ki)


def test_kcore_compat_holds_users_to_the_items_bound(spark):
    df = spark.createDataFrame([(1, 1), (2, 1), (1, 2), (2, 2), (3, 1)], "user_id int, item_id int")
    assert kcore.kcore(df, 1, 2).count() == 5
    assert kcore.kcore(df, 1, 2, compat=True).count() == 4
    assert kcore.kcore(df.limit(0)).count() == 0


def test_dense_index_and_string_index(spark):
    keys = [f"k{i}" for i in random.Random(2).sample(range(5000), 1000)]
    df = spark.createDataFrame([(k,) for k in keys + keys[:10] + [None]], "key string").repartition(7)
    got = index.StringIndex.build(df, "key")
    assert [(r.id, r.key) for r in got.table.orderBy("id").collect()] == list(enumerate(sorted(keys), 1)) and len(got) == 1000
    more = got.intern(spark.createDataFrame([("zz",), (keys[0],), ("aa",)], "key string"), "key")
    assert [r.key for r in more.table.where("id > 1000").orderBy("id").collect()] == ["aa", "zz"]
    with pytest.raises(ValueError, match="unknown"):
        got.lookup(spark.createDataFrame([("nope",)], "x string"), "x", "n", frozen=True)
    assert got.lookup(spark.createDataFrame([("nope",)], "x string"), "x", "n").first().n is None
    assert index.dense_index(df.limit(0), ["key"]).count() == 0


def test_string_index_files(spark, tmp_path):
    got = index.StringIndex.build(spark.createDataFrame([("b",), ("a",)], "key string"), "key")
    got.save(str(tmp_path / "i.parquet"))
    back = index.StringIndex.load(spark, str(tmp_path / "i.parquet"))
    assert sorted((r.id, r.key) for r in back.table.collect()) == [(1, "a"), (2, "b")]


def tables(spark):
    make = spark.createDataFrame
    return {
        "all_isbns": make([(i, f"isbn{i}") for i in range(1, 7)], "isbn_id int, isbn string"),
        "book_ids": make([(1,), (2,)], "rec_id int"),
        "editions": make([(1, "/e/1"), (2, "/e/2"), (3, "/e/3")], "id int, key string"),
        "works": make([(1, "/w/1")], "id int, key string"),
        "edition_works": make([(1, 1), (2, 1), (3, 2)], "edition int, work int"),
        "book_isbn_ids": make([(1, 1), (1, 1)], "rec_id int, isbn_id int"),
        "edition_isbn_ids": make([(1, 1), (2, 2), (3, 3)], "edition int, isbn_id int"),
        "gr_book_ids": make([(1, 1), (2, None)], "book_id int, work_id int"),
        "gr_book_isbn_ids": make([(1, 2), (2, 4)], "book_id int, isbn_id int"),
    }


def test_catalogue_graph(spark):
    t = tables(spark)
    edges = graph.catalogue_edges(t)
    clustered = graph.cluster_graph(graph.catalogue_nodes(t), edges)
    cluster = {r.book_code: r.cluster for r in clustered.collect()}
    code = ids.code_of
    big = code("OL-W", 1)
    assert {n for n, c in cluster.items() if c == big} == {big, code("OL-E", 1), code("OL-E", 2), code("ISBN", 1), code("ISBN", 2), code("LOC", 1), code("GR-B", 1), code("GR-W", 1)}
    assert cluster[code("ISBN", 3)] == code("OL-W", 2)  # a work that only an edition names
    assert cluster[code("ISBN", 5)] == code("ISBN", 5) and cluster[code("LOC", 2)] == code("LOC", 2)
    stats = {r.cluster: r for r in graph.cluster_stats(clustered).collect()}
    assert stats[big].n_nodes == 8 and stats[big].n_isbns == 2 and stats[big].n_gr_works == 1
    metrics = graph.cluster_metrics(graph.cluster_stats(clustered)).first()
    assert (metrics.clusters, metrics.largest, metrics.max_isbns) == (len(set(cluster.values())), 8, 2)
    assert graph.graph_edges(clustered, edges).where("src = 900000001").count() == 3  # a repeated edge stays
    assert graph.isbn_clusters(clustered).count() == 6
    nodes, inner = graph.subgraph(clustered, edges, [code("OL-W", 2)])
    assert nodes.count() == 3 and inner.count() == 2
    far = graph.distances(edges, code("ISBN", 3)).agg(F.max("distance")).first()[0]
    assert far == 2
    without = graph.catalogue_nodes(t, False)
    assert without.where(ids.in_namespace(F.col("book_code"), "GR-B")).count() == 0
    with pytest.raises(ValueError, match="unknown"):
        graph.cluster_graph(without, edges)


def test_gender_ladder(spark):
    make = spark.createDataFrame
    code = ids.code_of
    cases = {code("ISBN", 1): "no-book", code("OL-W", 1): "no-book-author", code("OL-W", 2): "no-author-rec", code("OL-W", 3): "no-gender", code("OL-W", 4): "female", code("OL-W", 5): "ambiguous", code("OL-W", 6): "unknown", code("OL-W", 7): "male"}
    by = make([(code("OL-W", 2), "Nobody"), (code("OL-W", 3), "Blank"), (code("OL-W", 4), "Eve"), (code("OL-W", 5), "Eve"), (code("OL-W", 5), "Max"), (code("OL-W", 6), "Una"), (code("OL-W", 7), "Max"), (code("OL-W", 7), "Una")], "cluster int, author_name string")
    heads = make([(1, "Blank"), (2, "Eve"), (3, "Max"), (4, "Una"), (5, "Eve")], "rec_id int, name string")
    genders = make([(2, "Female "), (3, "male"), (4, "unknown")], "rec_id int, gender string")
    got = authors.cluster_genders(make([(c,) for c in cases], "cluster int"), by, authors.name_table(heads, genders))
    assert {r.cluster: r.gender for r in got.collect()} == cases


def test_ratings_and_actions(spark):
    rows = [(1, 1, 3.0, 5, 1), (1, 1, 4.0, 5, 2), (1, 1, 1.0, 9, 0), (1, 1, None, 10, 9), (1, 2, None, 4, 3)]
    df = spark.createDataFrame(rows, "user_id int, item_id int, rating double, timestamp long, rec_id int")
    rated = interactions.cluster_ratings(df.where("rating is not null")).first()
    assert (rated.rating, rated.last_rating, rated.first_time, rated.last_time, rated.nratings) == (3.0, 1.0, 5, 9, 3)
    assert interactions.cluster_ratings(df.where("rating is not null"), order="rec_id").first().last_rating == 4.0
    acts = {r.item_id: r for r in interactions.cluster_actions(df, order="rec_id").collect()}
    assert (acts[1].nactions, acts[1].last_rating, acts[1].last_time) == (4, 4.0, 10)
    assert (acts[2].nactions, acts[2].last_rating) == (1, None)
    with pytest.raises(Exception, match="a rating is null"):
        interactions.dedup_with_median_time(df).collect()
    even = interactions.dedup_with_median_time(spark.createDataFrame([(1, 1, 2.0, 10), (1, 1, 4.0, 21)], "user_id int, item_id int, rating double, timestamp long")).first()
    assert (even.rating, even.timestamp, even.last_rating, even.nratings) == (3.0, 15, 4.0, 2)


def test_collect_link_and_checks(spark):
    a = spark.createDataFrame([(1, "x", None), (2, "y", "x")], "rec int, i10 string, i13 string")
    b = spark.createDataFrame([("x",), ("z",), (None,)], "isbn string")
    every = index.collect_ids({"A": (a, ["i10", "i13"]), "B": (b, ["isbn"])})
    assert [tuple(r) for r in every.orderBy("isbn_id").collect()] == [(1, "x", 2, 1), (2, "y", 1, 0), (3, "z", 0, 1)]
    assert sorted(tuple(r) for r in index.link_ids(a, "rec", ["i10", "i13"], every).collect()) == [(1, 1), (2, 1), (2, 2)]
    with pytest.raises(ValueError, match="nulls in isbn"):
        checks.assert_no_nulls(b, "isbn")
    assert checks.non_null_columns(a) == ["rec", "i10"]
    assert [r.v for r in checks.duplicated(spark.createDataFrame([(1,), (1,), (2,)], "v int"), "v").collect()] == [1]


def test_hashes_titles_and_versions(spark):
    members = spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (2, "c")], "cluster int, isbn string")
    import hashlib

    got = {r.cluster: (r.isbn_hash, r.isbn_dcode) for r in graph.cluster_hashes(members).collect()}
    for c, s in ((1, b"ab"), (2, b"c")):
        d = hashlib.md5(s).digest()
        assert got[c] == (d.hex(), d[-1] % 2)
    wide = spark.createDataFrame([(1, 5, 5), (2, None, 3), (3, 4, None), (4, 4, 5), (5, None, None)], "isbn_id int, v1 int, v2 int")
    seen = {r.v2: r.n for r in reports.trajectories(wide, ["v1", "v2"]).withColumnRenamed("count", "n").collect()}
    assert seen == {"same": 2, "added": 1, "dropped": 1, "changed": 1}
    ids_ = spark.createDataFrame([(1, 7, 400000007), (2, None, 500000002)], "book_id int, work_id int, item_id int")
    info = spark.createDataFrame([(2, "Book")], "book_id int, title string")
    work = spark.createDataFrame([(7, "Work")], "work_id int, title string")
    assert {(r.item_id, r.title) for r in works.item_titles(ids_, info, work).collect()} == {(400000007, "Work"), (500000002, "Book")}
