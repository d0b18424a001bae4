"""Queries that write the driver's tables as raw files of the sources' formats and read them through the sources.

Files are written in key order, so that a record's place in them is its key's rank.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tomeflow.operators.index import StringIndex
from tomeflow.plans.queries import QUERIES, SQL, query, seconds, table
from tomeflow.sources import amazon, files, goodreads, marc, openlibrary, sinks
from tomeflow.workspace import Workspace

__all__ = ["QUERIES", "SQL"]  # those of the other module, with this one's added


def _text_file(df: DataFrame, order: str, line: Column, name: str) -> str:
    """A folder of text files, compressed, whose lines are in order."""
    path = Workspace(df.sparkSession, "files").new_path(name)
    df.orderBy(order).select(line.alias("value")).write.option("compression", "gzip").text(path)
    return path


def _p(c: str) -> Column:
    return F.col(c).cast("string")


# Dumps of the open catalogue


def _editions(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    key = _p("p_partkey")
    doc = F.concat(
        F.lit('{"title": "'), "p_name", F.lit('", "isbn_10": ["'), F.lpad(key, 9, "1"), F.lit('-x", "12"], "isbn_13": [{"value": "978-'), F.lpad(key, 10, "2"),
        F.lit('"}], "asin": ["b'), F.lpad(key, 9, "0"), F.lit('"], "works": [{"key": "/works/OL'), (F.col("p_partkey") % 1009).cast("string"),
        F.lit('W"}], "authors": [{"key": "/authors/OL'), key, F.lit('A"}, {}, {"author": {"key": "/a/OL'), _p("p_size"),
        F.lit('A"}}, "/authors/OL7A"], "subjects": ["'), "p_type", F.lit('", {"value": "any"}], "subject_times": ["'), "p_brand", F.lit('"]}'),
    )
    line = F.concat(F.lit("/type/edition\t/books/OL"), key, F.lit("M\t3\t2020-01-01T00:00:00\t"), doc)
    return openlibrary.edition_tables(openlibrary.read_dump(spark, _text_file(table(spark, sf_dir, "part"), "p_partkey", line, "editions")))


_EDITIONS = "e AS (SELECT *, CAST(row_number() OVER (ORDER BY p_partkey) AS INT) AS id FROM part)"


@query(f"WITH {_EDITIONS} SELECT id, '/books/OL' || p_partkey || 'M' AS key, p_name AS title FROM e")
def dump_editions(spark, sf_dir):
    return _editions(spark, sf_dir)["editions"]


@query(f"""WITH {_EDITIONS} SELECT id AS edition, unnest([lpad(CAST(p_partkey AS VARCHAR), 9, '1') || 'X', '978' || lpad(CAST(p_partkey AS VARCHAR), 10, '2'),
        'B' || lpad(CAST(p_partkey AS VARCHAR), 9, '0')]) AS isbn FROM e""")
def dump_edition_isbns(spark, sf_dir):
    return _editions(spark, sf_dir)["edition_isbns"]


@query(f"WITH {_EDITIONS} SELECT id AS edition, CAST(p_partkey % 1009 AS INT) AS work FROM e")
def dump_edition_works(spark, sf_dir):
    return _editions(spark, sf_dir)["edition_works"]


@query(f"""WITH {_EDITIONS} SELECT id AS edition, a.pos AS pos, CAST(a.author AS INT) AS author
    FROM e, LATERAL (VALUES (0, p_partkey), (2, p_size), (3, 7)) AS a(pos, author)""")
def dump_edition_authors(spark, sf_dir):
    return _editions(spark, sf_dir)["edition_authors"]


@query(f"WITH {_EDITIONS} SELECT id, s.subj_type, s.subject FROM e, LATERAL (VALUES (71, p_type), (71, 'any'), (84, p_brand)) AS s(subj_type, subject)")
def dump_edition_subjects(spark, sf_dir):
    return _editions(spark, sf_dir)["edition_subjects"]


@query("""SELECT CAST(c_custkey AS INT) AS id, n.source, n.name FROM customer,
    LATERAL (VALUES (110, 'Ann ' || c_mktsegment), (112, 'Smith, Ann ' || c_mktsegment), (97, 'A' || c_custkey), (97, 'B' || c_nationkey)) AS n(source, name)""")
def dump_author_names(spark, sf_dir):
    key = _p("c_custkey")
    doc = F.concat(
        F.lit('{"name": "  Ann  '), "c_mktsegment", F.lit('", "personal_name": "Smith , Ann '), "c_mktsegment", F.lit('", "alternate_names": ["A'), key,
        F.lit('", {"value": "B'), _p("c_nationkey"), F.lit('"}]}'),
    )
    line = F.concat(F.lit("/type/author\t/authors/OL"), key, F.lit("A\t1\t2020-01-01T00:00:00\t"), doc)
    dump = openlibrary.read_dump(spark, _text_file(table(spark, sf_dir, "customer"), "c_custkey", line, "authors"))
    return openlibrary.author_tables(dump)["author_names"]


# Dumps of the reading site


def _feed(spark: SparkSession, df: DataFrame, order: str, schema: str, *fields: Column) -> DataFrame:
    line = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return goodreads.read(spark, _text_file(df, order, line, "feed"), schema)


def _books(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    key, size = _p("p_partkey"), F.col("p_size")
    author = lambda n, role: F.struct(n.cast("string").alias("author_id"), role.alias("role"))
    rows = _feed(
        spark, table(spark, sf_dir, "part"), "p_partkey", goodreads.BOOK,
        key.alias("book_id"), F.when(size <= 40, (F.col("p_partkey") % 1009).cast("string")).otherwise("").alias("work_id"),
        F.concat(F.lit(" "), F.lpad(key, 9, "1"), F.lit("-x ")).alias("isbn"), F.when(size % 2 == 0, "").otherwise("12-3").alias("isbn13"),
        F.concat(F.lit("b"), F.lpad(key, 9, "0")).alias("asin"), F.concat(F.lit("　"), "p_name", F.lit(" ")).alias("title"),
        F.array(author(size, F.lit("")), author(F.col("p_partkey"), F.col("p_type"))).alias("authors"),
        F.concat(F.lit("19"), F.lpad(size.cast("string"), 2, "0"), F.lit(" ")).alias("publication_year"), F.when(size % 2 == 0, "").otherwise("7").alias("publication_month"),
        F.array(F.col("p_brand"), F.lit("all")).alias("series"),
    )
    return goodreads.book_tables(rows)


@query("""SELECT CAST(p_partkey AS INT) AS book_id, CAST(CASE WHEN p_size <= 40 THEN p_partkey % 1009 END AS INT) AS work_id,
        CAST(CASE WHEN p_size <= 40 THEN 400000000 + p_partkey % 1009 ELSE 500000000 + p_partkey END AS INT) AS item_id,
        lpad(CAST(p_partkey AS VARCHAR), 9, '1') || 'X' AS isbn10, CAST(NULL AS VARCHAR) AS isbn13, 'B' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS asin FROM part""")
def feed_book_ids(spark, sf_dir):
    return _books(spark, sf_dir)["book_ids"]


@query("SELECT CAST(p_partkey AS INT) AS book_id, p_name AS title, 1900 + p_size AS pub_year, CASE WHEN p_size % 2 = 1 THEN 7 END AS pub_month FROM part")
def feed_book_info(spark, sf_dir):
    return _books(spark, sf_dir)["book_info"]


@query("""SELECT CAST(p_partkey AS INT) AS book_id, CAST(a.author_id AS INT) AS author_id, a.position, a.role
    FROM part, LATERAL (VALUES (p_size, 1, NULL), (p_partkey, 2, p_type)) AS a(author_id, "position", role)""")
def feed_book_authors(spark, sf_dir):
    return _books(spark, sf_dir)["book_authors"]


@query("SELECT CAST(p_partkey AS INT) AS book_id, unnest([p_brand, 'all']) AS series FROM part")
def feed_book_series(spark, sf_dir):
    return _books(spark, sf_dir)["book_series"]


@query("""WITH g AS (SELECT p_partkey, unnest([p_type, p_brand]) AS genre, unnest([p_size, 3]) AS n FROM part)
    SELECT CAST(p_partkey AS INT) AS book_id, CAST(dense_rank() OVER (ORDER BY genre) AS INT) AS genre_id, n AS count FROM g""")
def feed_book_genres(spark, sf_dir):
    genres = F.create_map(F.col("p_type"), F.col("p_size"), F.col("p_brand"), F.lit(3))
    return goodreads.genre_tables(_feed(spark, table(spark, sf_dir, "part"), "p_partkey", goodreads.GENRES, _p("p_partkey").alias("book_id"), genres.alias("genres")))["book_genres"]


@query("""SELECT CAST(o_orderkey AS INT) AS work_id, o_orderpriority AS title, CAST(year(o_orderdate) AS SMALLINT) AS pub_year, CAST(NULL AS SMALLINT) AS pub_month FROM orders""")
def feed_work_info(spark, sf_dir):
    rows = _feed(
        spark, table(spark, sf_dir, "orders"), "o_orderkey", goodreads.WORK, _p("o_orderkey").alias("work_id"), F.concat(F.lit(" "), "o_orderpriority").alias("original_title"),
        F.concat(F.lit(" "), F.year("o_orderdate").cast("string")).alias("original_publication_year"), F.lit(" ").alias("original_publication_month"),
    )
    return goodreads.work_info(rows)


@query("SELECT CAST(s_suppkey AS INT) AS author_id, CASE WHEN s_nationkey % 3 > 0 THEN s_name END AS name FROM supplier")
def feed_author_info(spark, sf_dir):
    name = F.when(F.col("s_nationkey") % 3 > 0, F.col("s_name")).otherwise("")
    return goodreads.author_info(_feed(spark, table(spark, sf_dir, "supplier"), "s_suppkey", goodreads.AUTHOR, _p("s_suppkey").alias("author_id"), name.alias("name")))


def _orders_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_format(F.col("o_orderdate").cast("timestamp_ntz"), "EEE MMM dd")
    written = F.concat(day, F.lit(" 00:00:37 -0700 "), F.year("o_orderdate").cast("string"))
    return _feed(
        spark, table(spark, sf_dir, "orders"), "o_orderkey", goodreads.REVIEW,
        F.concat(F.lit("u"), _p("o_custkey")).alias("user_id"), (F.col("o_orderkey") % 997).cast("string").alias("book_id"), F.md5(_p("o_orderkey")).alias("review_id"),
        F.when(F.col("o_orderstatus") == "F", True).alias("is_read"), F.when(F.col("o_orderstatus") != "F", False).alias("isRead"), (F.col("o_orderkey") % 6).alias("rating"),
        written.alias("date_added"), F.lit("").alias("read_at"), F.col("o_orderpriority").alias("review_text"), (F.col("o_orderkey") % 4).alias("n_votes"),
    )


_FEED = """f AS (SELECT *, CAST(row_number() OVER (ORDER BY o_orderkey) AS BIGINT) AS rec_id, CAST(dense_rank() OVER (ORDER BY 'u' || o_custkey) AS INT) AS user_id,
        CAST(o_orderkey % 997 AS INT) AS book_id, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_read, CASE WHEN o_orderkey % 6 > 0 THEN CAST(o_orderkey % 6 AS FLOAT) END AS rating,
        CAST(CAST(CAST(epoch(o_orderdate) AS BIGINT) + 37 + 3600 * 7 AS FLOAT) AS BIGINT) AS added FROM orders)"""


@query(f"WITH {_FEED} SELECT rec_id, user_id, book_id, is_read, rating, added, CAST(NULL AS BIGINT) AS updated, CAST(NULL AS BIGINT) AS read_finished FROM f")
def feed_interactions(spark, sf_dir):
    out = goodreads.interaction_tables(_orders_feed(spark, sf_dir))["interactions"]
    return out.select("rec_id", "user_id", "book_id", "is_read", "rating", *[F.col(c).cast("long").alias(c) for c in ("added", "updated", "read_finished")])


@query(f"""WITH {_FEED} SELECT rec_id, user_id, book_id, CAST(CASE WHEN book_id % 2 = 0 THEN book_id + 1 END AS INT) AS work_id,
        CAST(CASE WHEN book_id % 2 = 0 THEN 400000001 + book_id ELSE 500000000 + book_id END AS INT) AS item_id,
        is_read, rating, CAST(o_orderkey % 4 AS INT) AS n_votes, added, o_orderpriority AS review FROM f""")
def feed_reviews(spark, sf_dir):
    rows = _orders_feed(spark, sf_dir)
    users = StringIndex.build(rows, "user_id", "user", "user_id")
    book = F.col("book_id").cast("int")
    listed = rows.select("book_id").distinct().select(F.col("book_id"), F.when(book % 2 == 0, (book + 1).cast("string")).otherwise("").alias("work_id"))
    empty = [F.lit(None).cast(t).alias(c) for c, t in (x.split(" ") for x in ("isbn string", "isbn13 string", "asin string", "title string", "publication_year string", "publication_month string"))]
    books = goodreads.book_tables(listed.select("*", *empty, F.array().cast("array<struct<author_id:string,role:string>>").alias("authors"), F.array().cast("array<string>").alias("series")))["book_ids"]
    return goodreads.review_table(rows, users, books).drop("review_id", "updated").withColumn("added", F.col("added").cast("long"))


# Product ratings


@query("""SELECT CAST(dense_rank() OVER (ORDER BY 'u' || o_custkey) AS INT) AS user_id, 'B' || o_orderkey AS asin, CAST(o_orderkey % 5 + 1 AS FLOAT) AS rating,
        CAST(epoch(o_orderdate) AS BIGINT) AS "timestamp" FROM orders""")
def product_ratings(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.concat(F.lit("B"), _p("o_orderkey")).alias("asin"), F.concat(F.lit("u"), _p("o_custkey")).alias("user"), (F.col("o_orderkey") % 5 + 1.0).alias("rating"), seconds("o_orderdate").alias("timestamp"))
    path = Workspace(spark, "files").new_path("ratings")
    rows.write.csv(path, header=False)
    return amazon.rating_tables(amazon.read_ratings(spark, path, swap=True))["ratings"]


@query("""SELECT CAST(dense_rank() OVER (ORDER BY 'u' || c_custkey) AS INT) AS user_id, 'B' || c_nationkey AS asin, CAST(c_custkey % 5 + 1 AS FLOAT) AS rating, c_custkey AS "timestamp",
        CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE '' END AS summary, CASE WHEN c_custkey % 3 = 1 THEN c_mktsegment ELSE '' END AS text FROM customer QUALIFY c_custkey % 3 < 2""")
def product_reviews(spark, sf_dir):
    kind = F.col("c_custkey") % 3
    line = F.to_json(F.struct(
        F.concat(F.lit("u"), _p("c_custkey")).alias("reviewerID"), F.concat(F.lit("B"), _p("c_nationkey")).alias("asin"), (F.col("c_custkey") % 5 + 1.0).alias("overall"),
        F.col("c_custkey").alias("unixReviewTime"), F.when(kind == 0, F.concat(F.lit(" "), "c_name", F.lit("\n"))).alias("summary"), F.when(kind == 1, F.col("c_mktsegment")).alias("reviewText"),
    ))
    return amazon.review_tables(amazon.read_reviews(spark, _text_file(table(spark, sf_dir, "customer"), "c_custkey", line, "reviews")))["reviews"]


# Catalogue records


def _catalogue(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    key = _p("p_partkey")
    kind = F.when(F.col("p_size") % 3 == 0, "g").when(F.col("p_size") % 3 == 1, "a").otherwise("t")
    line = F.concat(
        key, F.lit("\t<record><leader>00000n"), kind, F.lit('m a22</leader><controlfield tag="001"> '), key, F.lit('</controlfield><controlfield tag="008">'), F.lpad(F.lit(""), 28, "x"),
        F.when(F.col("p_size") % 5 == 0, "f").otherwise(" "), F.lit('</controlfield><datafield tag="010" ind1=" " ind2=" "><subfield code="a"> l'), key,
        F.lit(' </subfield></datafield><datafield tag="020" ind1=" " ind2=" "><subfield code="a">'), F.lpad(key, 9, "1"),
        F.lit('X (pbk.)</subfield></datafield><datafield tag="100" ind1="1" ind2=" "><subfield code="a"> Smith , '), "p_type", F.lit(" </subfield></datafield></record>"),
    )
    path = _text_file(table(spark, sf_dir, "part"), "p_partkey", line, "catalogue")
    return marc.book_tables(marc.read_delimited(spark, path))


_CATALOGUE = "b AS (SELECT *, row_number() OVER (ORDER BY p_partkey) AS rec_id FROM part WHERE p_size % 3 > 0 AND p_size % 5 > 0)"


@query(f"""WITH {_CATALOGUE} SELECT rec_id, CAST(p_partkey AS VARCHAR) AS marc_cn, 'l' || p_partkey AS lccn, 110 AS status, CASE p_size % 3 WHEN 1 THEN 97 ELSE 116 END AS rec_type, 109 AS bib_level FROM b""")
def catalogue_ids(spark, sf_dir):
    return _catalogue(spark, sf_dir)["ids"]


@query(f"WITH {_CATALOGUE} SELECT rec_id, lpad(CAST(p_partkey AS VARCHAR), 9, '1') || 'X' AS isbn, 'pbk.' AS tag FROM b")
def catalogue_isbns(spark, sf_dir):
    return _catalogue(spark, sf_dir)["isbns"]


@query(f"WITH {_CATALOGUE} SELECT rec_id, 'Smith, ' || p_type AS author_name FROM b")
def catalogue_authors(spark, sf_dir):
    return _catalogue(spark, sf_dir)["authors"]


# Sinks


@query("SELECT s_suppkey, s_name || ', \"' || s_nationkey || '\"' AS s_name, s_acctbal FROM supplier")
def csv_written(spark, sf_dir):
    path = Workspace(spark, "files").new_path("csv")
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", F.concat("s_name", F.lit(', "'), _p("s_nationkey"), F.lit('"')).alias("s_name"), "s_acctbal")
    sinks.write_csv(rows, path)
    return files.read_csv(spark, path, rows.schema)


@query("SELECT c_custkey, c_name, CASE WHEN c_nationkey > 3 THEN c_nationkey END AS nation FROM customer")
def parquet_written(spark, sf_dir):
    path = Workspace(spark, "files").new_path("table")
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.when(F.col("c_nationkey") > 3, F.col("c_nationkey")).alias("nation"))
    sinks.write_table(rows, path, non_null=("c_custkey", "c_name"), dictionary=("nation",))
    return files.read_table(spark, path)


@query("""SELECT 'c_custkey' AS name, false AS nullable, count(*) AS row_count FROM customer UNION ALL SELECT 'nation', true, count(*) FROM customer""")
def table_facts(spark, sf_dir):
    path = Workspace(spark, "files").new_path("facts")
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_nationkey") > 3, F.col("c_nationkey")).alias("nation"))
    sinks.write_table(rows, path)
    info = sinks.table_info(spark, path, check_length=True)
    facts = [(f.name, f.nullable, info["row_count"]) for f in sinks.tightened_schema(rows).fields]
    return spark.createDataFrame(facts, "name string, nullable boolean, row_count long")
