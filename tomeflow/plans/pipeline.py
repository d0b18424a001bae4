"""The stages of an integration run: what each reads, what it writes, and which may be skipped.

A stage is a function of a :class:`Store`, which reads and writes Parquet tables below one root.
A stage whose inputs, tables or raw files, are those of its last run is skipped.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tomeflow.functions import ids
from tomeflow.functions.dates import year_range
from tomeflow.functions.names import index_names
from tomeflow.operators import authors, graph, index, interactions, kcore, reports, works
from tomeflow.plans.config import Config
from tomeflow.sources import amazon, bookcrossing, goodreads, marc, openlibrary
from tomeflow.sources.sinks import write_csv, write_metrics, write_table


@dataclass
class Store:
    """Tables of a run below one folder that driver and executors share."""

    spark: SparkSession
    root: str
    config: Config

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.parquet"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def write(self, name: str, df: DataFrame, *non_null: str) -> None:
        write_table(df, self.path(name), non_null)

    def write_all(self, prefix: str, tables: dict[str, DataFrame]) -> None:
        for name, df in tables.items():
            self.write(f"{prefix}/{name}", df)


@dataclass
class Stage:
    name: str
    run: Callable[[Store], None]
    inputs: tuple[str, ...] = ()
    outputs: tuple[str, ...] = ()
    needs: str | None = None  # a source that must be enabled
    raw: tuple[str, ...] = ()  # patterns of the files below root/raw that it reads


def scan_catalogue(s: Store) -> None:
    s.write_all("loc", marc.book_tables(marc.read_documents(s.spark, f"{s.root}/raw/loc-books/*")))


def scan_authorities(s: Store) -> None:
    s.write("viaf/fields", marc.flat_fields(marc.read_delimited(s.spark, f"{s.root}/raw/viaf/*")))


def author_genders(s: Store) -> None:
    s.write("viaf/author_genders", marc.filter_fields(s.read("viaf/fields"), 375, "a", trim=True, lower=True, name="gender"))


def author_names(s: Store) -> None:
    names = index_names(marc.filter_fields(s.read("viaf/fields"), 700, "a"))
    s.write("viaf/author_name_index", names)
    write_csv(s.read("viaf/author_name_index"), f"{s.root}/viaf/author_name_index.csv.gz")


def scan_open_catalogue(s: Store) -> None:
    for kind, tables in (("authors", openlibrary.author_tables), ("works", openlibrary.work_tables), ("editions", openlibrary.edition_tables)):
        s.write_all("openlibrary", tables(openlibrary.read_dump(s.spark, f"{s.root}/raw/openlibrary/{kind}*")))


def scan_reading_site(s: Store) -> None:
    raw = lambda name, schema: goodreads.read(s.spark, f"{s.root}/raw/goodreads/{name}*", schema)
    s.write_all("goodreads", goodreads.book_tables(raw("books", goodreads.BOOK)))
    s.write("goodreads/work_info", goodreads.work_info(raw("works", goodreads.WORK)))
    s.write("goodreads/author_info", goodreads.author_info(raw("authors", goodreads.AUTHOR)))
    s.write_all("goodreads", goodreads.genre_tables(raw("genres", goodreads.GENRES)))
    s.write_all("goodreads", goodreads.interaction_tables(raw("interactions", goodreads.INTERACTION)))


def scan_reviews(s: Store) -> None:
    users = index.StringIndex(s.read("goodreads/users"), "user", "user_id")
    rows = goodreads.read(s.spark, f"{s.root}/raw/goodreads/reviews*", goodreads.REVIEW)
    s.write("goodreads/reviews", goodreads.review_table(rows, users, s.read("goodreads/book_ids")))


def scan_ratings(year: str, swap: bool) -> Callable[[Store], None]:
    def run(s: Store) -> None:
        s.write_all(year, amazon.rating_tables(amazon.read_ratings(s.spark, f"{s.root}/raw/{year}/*", swap)))

    return run


def scan_swaps(s: Store) -> None:
    s.write("bx/ratings", bookcrossing.read_ratings(s.spark, f"{s.root}/raw/bx/*.zip"))


def collect_isbns(s: Store) -> None:
    sources = {"LOC": ("loc/isbns", ["isbn"]), "OL": ("openlibrary/edition_isbns", ["isbn"]), "GR": ("goodreads/book_ids", ["isbn10", "isbn13", "asin"]),
               "BX": ("bx/ratings", ["isbn"]), "AZ14": ("az2014/ratings", ["asin"]), "AZ18": ("az2018/ratings", ["asin"])}
    s.write("links/all_isbns", index.collect_ids({k: (s.read(t), c) for k, (t, c) in sources.items() if s.config.is_enabled(k)}), "isbn_id", "isbn")


def link_isbns(s: Store) -> None:
    every = s.read("links/all_isbns")
    s.write("loc/book_isbn_ids", index.link_ids(s.read("loc/isbns"), "rec_id", ["isbn"], every))
    s.write("openlibrary/edition_isbn_ids", index.link_ids(s.read("openlibrary/edition_isbns"), "edition", ["isbn"], every))
    if s.config.is_enabled("goodreads"):
        s.write("goodreads/book_isbn_ids", index.link_ids(s.read("goodreads/book_ids"), "book_id", ["isbn10", "isbn13", "asin"], every))


def cluster_books(s: Store) -> None:
    names = {"all_isbns": "links/all_isbns", "book_ids": "loc/ids", "editions": "openlibrary/editions", "works": "openlibrary/works", "edition_works": "openlibrary/edition_works",
             "book_isbn_ids": "loc/book_isbn_ids", "edition_isbn_ids": "openlibrary/edition_isbn_ids"}
    readers = s.config.is_enabled("goodreads")
    if readers:
        names |= {"gr_book_ids": "goodreads/book_ids", "gr_book_isbn_ids": "goodreads/book_isbn_ids"}
    tables = {k: s.read(v) for k, v in names.items()}
    edges = graph.catalogue_edges(tables, readers)
    s.write("links/clustered", graph.cluster_graph(graph.catalogue_nodes(tables, readers), edges))
    clustered = s.read("links/clustered")
    s.write("links/isbn_clusters", graph.isbn_clusters(clustered))
    s.write("links/graph_nodes", graph.graph_nodes(clustered))
    s.write("links/graph_edges", graph.graph_edges(clustered, edges))
    s.write("links/cluster_stats", graph.cluster_stats(clustered))
    write_metrics(graph.cluster_metrics(s.read("links/cluster_stats")), f"{s.root.removeprefix('file://')}/links/cluster_metrics.json")


def cluster_hashes(s: Store) -> None:
    s.write("links/cluster_hashes", graph.cluster_hashes(s.read("links/isbn_clusters")))


def extract_books(s: Store) -> None:
    clustered = s.read("links/clustered")
    s.write("openlibrary/work_clusters", graph.extract_books(clustered, "OL-W", "work_id"))
    if s.config.is_enabled("goodreads"):
        s.write("goodreads/book_link", graph.extract_books(clustered, "GR-B", "book_id", s.read("goodreads/book_ids").select("book_id", "work_id")))


def cluster_authors(s: Store) -> None:
    clusters = s.read("links/isbn_clusters")
    by_edition = authors.edition_authors(
        clusters, s.read("openlibrary/edition_isbn_ids"), s.read("openlibrary/edition_authors"), s.read("openlibrary/author_names"), first_only=True
    )
    by_record = authors.catalogue_authors(clusters, s.read("loc/book_isbn_ids"), s.read("loc/authors"))
    s.write("links/cluster_first_authors", authors.cluster_authors(by_edition, by_record))


def cluster_genders(s: Store) -> None:
    names = authors.name_table(s.read("viaf/author_name_index"), s.read("viaf/author_genders"))
    s.write("links/cluster_genders", authors.cluster_genders(s.read("links/cluster_stats"), s.read("links/cluster_first_authors"), names))


def _with_clusters(s: Store, ratings: DataFrame, key: str) -> DataFrame:
    return interactions.link_items(ratings, s.read("links/isbn_clusters"), key, "isbn")


def cluster_product_ratings(year: str) -> Callable[[Store], None]:
    def run(s: Store) -> None:
        s.write(f"{year}/cluster_ratings", interactions.cluster_ratings(_with_clusters(s, s.read(f"{year}/ratings"), "asin")))
        s.write(f"{year}/cluster_ratings_5core", kcore.kcore(s.read(f"{year}/cluster_ratings")))

    return run


def swap_rows(ratings: DataFrame, clusters: DataFrame, rated: bool) -> DataFrame:
    """Ratings of clusters where a rating is given, or all actions."""
    linked = interactions.link_items(ratings.withColumnRenamed("user", "user_id"), clusters, "isbn", "isbn")
    if rated:
        return interactions.cluster_ratings(interactions.explicit_only(linked), time=None)
    return interactions.cluster_actions(linked, time=None, rating=None)


def cluster_swaps(s: Store) -> None:
    for what in ("actions", "ratings"):
        s.write(f"bx/cluster_{what}", swap_rows(s.read("bx/ratings"), s.read("links/isbn_clusters"), what == "ratings"))


def shelf_rows(rows: DataFrame, books: DataFrame, kind: str, native: bool) -> DataFrame:
    """Ratings or actions of clusters (by the books' links) or, ``native``, of works (by the books' identifiers)."""
    items = books.select("book_id", "item_id" if native else F.col("cluster").alias("item_id"))
    linked = rows.withColumn("timestamp", F.col("added").cast("long")).join(items, "book_id")
    if kind == "actions":
        return interactions.cluster_actions(linked, order="rec_id")
    rated = interactions.cluster_ratings(linked.where("rating is not null"), order="rec_id")
    return rated.withColumn("rating", F.col("rating").cast("float"))


def cluster_shelves(s: Store) -> None:
    for kind, books in (("cluster", "goodreads/book_link"), ("work", "goodreads/book_ids")):
        for what in ("ratings", "actions"):
            s.write(f"goodreads/{kind}_{what}", shelf_rows(s.read("goodreads/interactions"), s.read(books), what, kind == "work"))
            s.write(f"goodreads/{kind}_{what}_5core", kcore.kcore(s.read(f"goodreads/{kind}_{what}")))


def year_cores(s: Store) -> None:
    """Users of ten works or more and works of a hundred users or more, in one year."""
    for what in ("ratings", "actions"):
        rows = kcore.time_range(s.read(f"goodreads/work_{what}"), *year_range(2015))
        s.write(f"goodreads/work_{what}_2015_100_10core", kcore.kcore(rows, user_k=10, item_k=100))


def reader_dataset(s: Store) -> None:
    tables = works.recommender_dataset(s.read("goodreads/work_actions_5core"), s.read("goodreads/genres"), s.read("goodreads/work_item_genres"), s.read("goodreads/work_item_titles"))
    s.write_all("goodreads/dataset", tables)


def first_works(s: Store) -> None:
    books, info = s.read("goodreads/book_ids"), s.read("goodreads/book_info")
    found = works.first_books(s.read("goodreads/interactions"), books.where("work_id is not null"), info, s.read("goodreads/book_authors"))
    s.write("goodreads/author_first_works", found)
    table = s.read("goodreads/author_first_works")
    write_csv(table, f"{s.root}/goodreads/author_first_works.csv", compressed=False)
    for name, rows, key in (("author_names", "author_info", "author_id"), ("work_titles", "work_info", "work_id")):
        write_csv(s.read(f"goodreads/{rows}").join(table.select(key).distinct(), key, "left_semi"), f"{s.root}/goodreads/first_{name}.csv", compressed=False)


def work_tables(s: Store) -> None:
    books = s.read("goodreads/book_ids")
    s.write("goodreads/work_item_titles", works.item_titles(books, s.read("goodreads/book_info"), s.read("goodreads/work_info")))
    s.write("goodreads/work_item_genres", works.item_genres(books, s.read("goodreads/book_genres")))
    for first in (False, True):
        s.write(f"goodreads/work_item_{'first_' if first else ''}authors", works.item_authors(books, s.read("goodreads/book_authors"), s.read("goodreads/author_info"), first))
    s.write("goodreads/work_all_actions", works.all_actions(s.read("goodreads/interactions"), books))
    s.write("goodreads/work_gender", works.work_genders(s.read("goodreads/book_link"), s.read("links/cluster_genders")))


def integration_stats(s: Store) -> None:
    genders = s.read("links/cluster_genders")
    catalogue = s.read("loc/book_isbn_ids").join(s.read("links/isbn_clusters").select("isbn_id", F.col("cluster").alias("item_id")), "isbn_id")
    parts = [reports.gender_coverage("LOC-MDS", catalogue, genders, actions=False)]
    for source, name, table in (("goodreads", "GR-R", "goodreads/cluster_ratings"), ("goodreads", "GR-I", "goodreads/cluster_actions"), ("bx", "BX-R", "bx/cluster_ratings"),
                                ("bx", "BX-I", "bx/cluster_actions"), ("az2014", "AZ14", "az2014/cluster_ratings"), ("az2018", "AZ18", "az2018/cluster_ratings")):
        if s.config.is_enabled(source):
            parts.append(reports.gender_coverage(name, s.read(table), genders))
    write_csv(reports.integration_stats(parts), f"{s.root}/links/gender_stats.csv", compressed=False, single=True)


_GR = tuple(f"goodreads/{t}" for t in ("book_ids", "book_info", "book_authors", "book_series", "work_info", "author_info", "book_genres", "genres", "interactions", "users"))
_OL = tuple(f"openlibrary/{t}" for t in ("authors", "author_names", "works", "work_authors", "work_subjects", "editions", "edition_isbns", "edition_works", "edition_authors", "edition_subjects"))

_WORK_TABLES = tuple(f"goodreads/work_{t}" for t in ("item_titles", "item_genres", "item_authors", "item_first_authors", "all_actions", "gender"))
_SHELVES = tuple(f"goodreads/{kind}_{what}{core}" for kind in ("cluster", "work") for what in ("ratings", "actions") for core in ("", "_5core"))
_CODED = ("links/all_isbns", "loc/ids", "loc/book_isbn_ids", "goodreads/book_ids", "goodreads/book_isbn_ids", "openlibrary/edition_isbn_ids", *(f"openlibrary/{t}" for t in ("editions", "works", "edition_works")))
_LINKS = ("links/clustered", "links/isbn_clusters", "links/graph_nodes", "links/graph_edges", "links/cluster_stats")
_ISBNS = ("loc/isbns", "openlibrary/edition_isbns", "goodreads/book_ids")
_RATED = ("goodreads/cluster_ratings", "goodreads/cluster_actions", "bx/cluster_ratings", "bx/cluster_actions", "az2014/cluster_ratings", "az2018/cluster_ratings")

STAGES = (
    Stage("scan-catalogue", scan_catalogue, (), ("loc/fields", "loc/ids", "loc/isbns", "loc/authors"), raw=("loc-books/*",)),
    Stage("scan-authorities", scan_authorities, (), ("viaf/fields",), raw=("viaf/*",)),
    Stage("author-genders", author_genders, ("viaf/fields",), ("viaf/author_genders",)),
    Stage("author-names", author_names, ("viaf/fields",), ("viaf/author_name_index",)),
    Stage("scan-open-catalogue", scan_open_catalogue, (), _OL, raw=("openlibrary/*",)),
    Stage("scan-reading-site", scan_reading_site, (), _GR, "goodreads", tuple(f"goodreads/{t}*" for t in ("books", "works", "authors", "genres", "interactions"))),
    Stage("scan-reviews", scan_reviews, ("goodreads/users", "goodreads/book_ids"), ("goodreads/reviews",), "goodreads", ("goodreads/reviews*",)),
    Stage("scan-az2014", scan_ratings("az2014", False), (), ("az2014/ratings", "az2014/users"), "az2014", ("az2014/*",)),
    Stage("scan-az2018", scan_ratings("az2018", True), (), ("az2018/ratings", "az2018/users"), "az2018", ("az2018/*",)),
    Stage("scan-bx", scan_swaps, (), ("bx/ratings",), "bx", ("bx/*.zip",)),
    Stage("collect-isbns", collect_isbns, (*_ISBNS, "bx/ratings", "az2014/ratings", "az2018/ratings"), ("links/all_isbns",)),
    Stage("link-isbns", link_isbns, ("links/all_isbns", *_ISBNS), ("loc/book_isbn_ids", "openlibrary/edition_isbn_ids")),
    Stage("cluster-books", cluster_books, _CODED, _LINKS),
    Stage("cluster-hashes", cluster_hashes, ("links/isbn_clusters",), ("links/cluster_hashes",)),
    Stage("extract-books", extract_books, ("links/clustered", "goodreads/book_ids"), ("openlibrary/work_clusters",)),
    Stage("cluster-authors", cluster_authors, ("links/isbn_clusters", "openlibrary/edition_isbn_ids", "openlibrary/edition_authors", "openlibrary/author_names", "loc/book_isbn_ids", "loc/authors"), ("links/cluster_first_authors",)),
    Stage("cluster-genders", cluster_genders, ("links/cluster_stats", "links/cluster_first_authors", "viaf/author_name_index", "viaf/author_genders"), ("links/cluster_genders",)),
    Stage("cluster-az2014", cluster_product_ratings("az2014"), ("links/isbn_clusters", "az2014/ratings"), ("az2014/cluster_ratings", "az2014/cluster_ratings_5core"), "az2014"),
    Stage("cluster-az2018", cluster_product_ratings("az2018"), ("links/isbn_clusters", "az2018/ratings"), ("az2018/cluster_ratings", "az2018/cluster_ratings_5core"), "az2018"),
    Stage("cluster-bx", cluster_swaps, ("links/isbn_clusters", "bx/ratings"), ("bx/cluster_actions", "bx/cluster_ratings"), "bx"),
    Stage("cluster-shelves", cluster_shelves, ("goodreads/book_link", "goodreads/book_ids", "goodreads/interactions"), _SHELVES, "goodreads"),
    Stage("year-cores", year_cores, ("goodreads/work_ratings", "goodreads/work_actions"), tuple(f"goodreads/work_{what}_2015_100_10core" for what in ("ratings", "actions")), "goodreads"),
    Stage("work-tables", work_tables, ("links/cluster_genders", "goodreads/book_link", "goodreads/interactions", *_GR[:2], "goodreads/work_info", "goodreads/book_genres", "goodreads/book_authors", "goodreads/author_info"), _WORK_TABLES, "goodreads"),
    Stage("reader-dataset", reader_dataset, ("goodreads/work_actions_5core", "goodreads/genres", "goodreads/work_item_genres", "goodreads/work_item_titles"), ("goodreads/dataset/interactions",), "goodreads"),
    Stage("first-works", first_works, ("goodreads/interactions", *_GR[:3], "goodreads/author_info", "goodreads/work_info"), ("goodreads/author_first_works",), "goodreads"),
    Stage("integration-stats", integration_stats, ("links/cluster_genders", "loc/book_isbn_ids", "links/isbn_clusters", *_RATED), ()),
)


def _fingerprint(s: Store, stage: Stage) -> str:
    """Names, sizes and times of all files that a stage reads; a table that a run without its source lacks is no file."""
    path = s.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = s.spark.sparkContext._jsc.hadoopConfiguration()
    seen = []
    for pattern in (*(f"{s.path(name)}/*" for name in stage.inputs), *(f"{s.root}/raw/{name}" for name in stage.raw)):
        at = path(pattern)
        for f in at.getFileSystem(conf).globStatus(at) or ():
            seen.append(f"{f.getPath()}:{f.getLen()}:{f.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(seen)).encode()).hexdigest()


def run(store: Store, only: tuple[str, ...] = (), state: dict[str, str] | None = None, state_path: str | None = None) -> list[str]:
    """Run the enabled stages in order; returns the names of those that ran.

    ``state`` maps stages to the fingerprints of their inputs at their last run, and is updated.
    ``state_path`` names a file of the driver that keeps it between runs, written after every stage,
    so that a run that was broken off goes on where it stopped.
    """
    ran = []
    state = load_state(state_path) if state is None else state
    for stage in STAGES:
        if stage.needs and not store.config.is_enabled(stage.needs) or only and stage.name not in only:
            continue
        mark = _fingerprint(store, stage)
        if state.get(stage.name) != mark:
            stage.run(store)
            state[stage.name] = mark
            ran.append(stage.name)
            if state_path:
                save_state(state, state_path)
    return ran


def load_state(path: str | None) -> dict[str, str]:
    if not path or not os.path.exists(path):
        return {}
    with open(path) as f:
        return json.load(f)


def save_state(state: dict[str, str], path: str) -> None:
    with open(path, "w") as f:
        json.dump(state, f, indent=1)


def namespace_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(n, k, k * ids.WIDTH) for n, k in ids.NAMESPACES.items()], "name string, code int, base int")
