"""Readers and writers on small files of every source, and the whole run from raw files to statistics."""

import gzip
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from tomeflow.functions import ids
from tomeflow.functions.text import nfd_text
from tomeflow.plans import cli, pipeline
from tomeflow.plans.config import Config, parse_config
from tomeflow.sources import amazon, bookcrossing, files, goodreads, marc, openlibrary, sinks


def marc_record(number, kind="a", isbns=(), authors=(), f008=None, lccn=None, control=True):
    fields = "".join(f'<datafield tag="020" ind1=" " ind2=" "><subfield code="a">{i}</subfield></datafield>' for i in isbns)
    fields += "".join(f'<datafield tag="100" ind1="1" ind2=" "><subfield code="a">{a}</subfield><subfield code="d">x</subfield></datafield>' for a in authors)
    if lccn:
        fields += f'<datafield tag="010" ind1=" " ind2=" "><subfield code="a"> {lccn} </subfield></datafield>'
    c = f'<controlfield tag="001"> {number} </controlfield>' if control else ""
    c += f'<controlfield tag="008">{f008}</controlfield>' if f008 is not None else ""
    return f"<record><leader>00000n{kind}m a22</leader>{c}{fields}</record>"


def test_marc_books(spark, tmp_path):
    body = [
        marc_record(1, isbns=["349224010X (pbk.) (set)", "9780329489391"], authors=["Smith, J. &amp; Co.", " . "], lccn="n 12"),
        marc_record(2, kind="e", isbns=["1234567890"]),
        marc_record(3, kind="t", f008="0" * 28 + "f"),
        marc_record(4, kind="t", f008="0" * 28 + "|"),
        marc_record(5, f008="short"),
    ]
    (tmp_path / "a.xml").write_text('<?xml version="1.0"?><collection xmlns="http://www.loc.gov/MARC21/slim">' + "\n".join(body) + "</collection>")
    records = marc.read_documents(spark, str(tmp_path / "a.xml"))
    assert [r.rec_id for r in records.orderBy("rec_id").collect()] == [1, 2, 3, 4, 5]
    t = marc.book_tables(records)
    got = t["ids"].orderBy("rec_id").collect()
    assert [(r.rec_id, r.marc_cn, r.lccn, chr(r.rec_type)) for r in got] == [(1, "1", "n 12", "a"), (2, "4", None, "t"), (3, "5", None, "a")]
    assert sorted((r.rec_id, r.isbn, r.tag or "") for r in t["isbns"].collect()) == [(1, "349224010X", "pbk."), (1, "349224010X", "set"), (1, "9780329489391", "")]
    assert [(r.rec_id, r.author_name) for r in t["authors"].collect()] == [(1, "Smith, J & Co")]
    flat = t["fields"].where("rec_id = 1").orderBy("fld_no").collect()
    assert (flat[0].tag, flat[0].sf_code, flat[1].tag, flat[1].contents) == (-1, 0, 1, " 1 ") and [r.fld_no for r in flat] == list(range(len(flat)))
    (tmp_path / "bad.xml").write_text(f"<collection>{marc_record(1, control=False)}</collection>")
    with pytest.raises(Exception, match="no control number"):
        marc.book_tables(marc.read_documents(spark, str(tmp_path / "bad.xml")))["ids"].collect()


def test_delimited_records_in_several_gzip_members(spark, tmp_path):
    with open(tmp_path / "v.txt.gz", "wb") as f:
        for k in (1, 2, 3):
            f.write(gzip.compress(f'viaf{k}\t<r:record xmlns:r="x"><r:leader>l{k}</r:leader><r:datafield tag="375" ind1=" " ind2=" "><r:subfield code="a"> Female </r:subfield><r:subfield code="a">male</r:subfield></r:datafield></r:record>\n'.encode()))
    fields = marc.flat_fields(marc.read_delimited(spark, str(tmp_path / "v.txt.gz")))
    assert [r.contents for r in fields.where("fld_no = 0").orderBy("rec_id").collect()] == ["l1", "l2", "l3"]
    kept = marc.filter_fields(fields, 375, "a", trim=True, lower=True, name="gender")
    assert sorted((r.rec_id, r.gender) for r in kept.collect()) == [(k, g) for k in (1, 2, 3) for g in ("female", "male")]
    assert marc.filter_fields(fields).count() == fields.count()


def dump(rows):
    return "".join(f"/type/x\t{key}\t1\t2020\t{json.dumps(doc)}\n" for key, doc in rows)


def test_open_catalogue(spark, tmp_path):
    p = tmp_path / "d.txt"
    p.write_text(dump([("/authors/OL2A", {"name": "metäl.", "alternate_names": ["B.  C", "d"]}), ("/authors/OL3A", {"personal_name": "P"})]))
    t = openlibrary.author_tables(openlibrary.read_dump(spark, str(p)))
    assert [(r.id, r.name) for r in t["authors"].orderBy("id").collect()] == [(2, nfd_text("metäl.")), (3, None)]
    assert sorted((r.id, chr(r.source), r.name) for r in t["author_names"].collect()) == [(2, "a", "B C"), (2, "a", "d"), (2, "n", nfd_text("metäl")), (3, "p", "P")]
    e = tmp_path / "e.txt"
    e.write_text(dump([
        ("/books/OL9M", {"title": "T", "isbn_10": ["349224010x", "12"], "asin": ["b00-abcdef"], "works": [{"key": "/works/OL5W"}], "authors": [{"key": "/authors/OL2A"}, {}, "/authors/OL3A", {"author": {"key": "/authors/OL4A"}}], "subjects": ["s", {"value": "v"}], "subject_places": ["p"]}),
        ("/books/OL1M", {}),
    ]))
    t = openlibrary.edition_tables(openlibrary.read_dump(spark, str(e)))
    assert [(r.id, r.key, r.title) for r in t["editions"].orderBy("id").collect()] == [(1, "/books/OL9M", "T"), (2, "/books/OL1M", None)]
    assert sorted(r.isbn for r in t["edition_isbns"].collect()) == ["349224010X", "B00ABCDEF"]
    assert [(r.edition, r.work) for r in t["edition_works"].collect()] == [(1, 5)]
    assert [(r.pos, r.author) for r in t["edition_authors"].orderBy("pos").collect()] == [(0, 2), (2, 3), (3, 4)]
    assert sorted((chr(r.subj_type), r.subject) for r in t["edition_subjects"].collect()) == [("G", "s"), ("G", "v"), ("L", "p")]
    (tmp_path / "bad.txt").write_text("a\tb\tc\n")
    with pytest.raises(Exception, match="not a record"):
        openlibrary.read_dump(spark, str(tmp_path / "bad.txt")).collect()


def lines(path, rows):
    with gzip.open(path, "wt") as f:
        f.writelines(json.dumps(r) + "\n" for r in rows)
    return str(path)


DAY = "Tue Oct 03 10:28:16 -0700 2017"


def interaction(user, book, n, rating=0, **more):
    return {"user_id": user, "book_id": str(book), "review_id": f"{n:032x}", "isRead": True, "rating": rating, "date_added": DAY, "date_updated": DAY, "read_at": "", "started_at": DAY, **more}


BOOKS = [
    {"book_id": "1", "work_id": "7", "isbn": " 349224010X ", "isbn13": "", "asin": "123", "title": " T ", "authors": [{"author_id": "5", "role": ""}, {"author_id": "6", "role": "Editor"}], "publication_year": "2009", "publication_month": "", "publication_day": "", "series": ["s"]},
    {"book_id": "2", "work_id": "", "isbn": "", "isbn13": "9780329489391", "asin": "", "title": "", "authors": [], "publication_year": "", "publication_month": "", "publication_day": "", "series": []},
]


def test_reading_site(spark, tmp_path):
    t = goodreads.book_tables(goodreads.read(spark, lines(tmp_path / "b.json.gz", BOOKS), goodreads.BOOK))
    got = t["book_ids"].orderBy("book_id").collect()
    assert [(r.work_id, r.item_id, r.isbn10, r.isbn13, r.asin) for r in got] == [(7, 400000007, "349224010X", None, None), (None, 500000002, None, "9780329489391", None)]
    assert [(r.title, r.pub_year, r.pub_month) for r in t["book_info"].orderBy("book_id").collect()] == [("T", 2009, None), (None, None, None)]
    assert [(r.author_id, r.position, r.role) for r in t["book_authors"].orderBy("position").collect()] == [(5, 1, None), (6, 2, "Editor")]
    rows = goodreads.read(spark, lines(tmp_path / "i.json.gz", [interaction("u2", 1, 3, 4), interaction("u1", 2, (1 << 127) + 1), interaction("u1", 1, 3)]), goodreads.INTERACTION)
    t = goodreads.interaction_tables(rows)
    got = t["interactions"].orderBy("rec_id").collect()
    assert [(r.rec_id, r.user_id, r.rating, r.is_read, int(r.added)) for r in got] == [(1, 2, 4.0, 1, 1507051648), (2, 1, None, 1, 1507051648), (3, 1, None, 1, 1507051648)]
    assert got[1].review_id == -(2**63) + 1 and got[0].read_finished is None and got[0].read_started is not None
    assert [r.review_id for r in goodreads.duplicate_reviews(t["interactions"]).collect()] == [3]
    assert goodreads.suspect_times(t["interactions"], "added", 2018).count() == 3
    genres = goodreads.genre_tables(goodreads.read(spark, lines(tmp_path / "g.json.gz", [{"book_id": "1", "genres": {"b": 2, "a": 1}}]), goodreads.GENRES))
    assert [(r.genre_id, r.genre) for r in genres["genres"].orderBy("genre_id").collect()] == [(1, "a"), (2, "b")]


def test_products_and_swaps(spark, tmp_path):
    (tmp_path / "r.csv").write_text("A,349224010X,4.0,100\nB,349224010X,2.0,50\n")
    t = amazon.rating_tables(amazon.read_ratings(spark, str(tmp_path / "r.csv")))
    assert sorted((r.user_id, r.asin, r.rating, r.timestamp) for r in t["ratings"].collect()) == [(1, "349224010X", 4.0, 100), (2, "349224010X", 2.0, 50)]
    (tmp_path / "s.csv").write_text("349224010X,A,4.0,100\n")
    assert amazon.read_ratings(spark, str(tmp_path / "s.csv"), swap=True).first().user == "A"
    (tmp_path / "bad.csv").write_text("A,x,four,100\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        amazon.read_ratings(spark, str(tmp_path / "bad.csv")).collect()
    rows = [{"reviewerID": "A", "asin": "x", "overall": 5, "unixReviewTime": 1, "summary": " s "}, {"reviewerID": "A", "asin": "y", "overall": 1, "unixReviewTime": 2}]
    t = amazon.review_tables(amazon.read_reviews(spark, lines(tmp_path / "v.json.gz", rows)))
    assert t["ratings"].count() == 2 and [(r.summary, r.text) for r in t["reviews"].collect()] == [("s", "")]
    with zipfile.ZipFile(tmp_path / "bx.zip", "w") as z:
        z.writestr("BX-Book-Ratings.csv", '"User-ID";"ISBN";"Book-Rating"\r\n"1";"349224010x";"0"\r\n"2";"é---";"5"\r\n"3";"0 O12";"7"\r\n'.encode("latin-1"))
    assert sorted((r.user, r.isbn, r.rating) for r in bookcrossing.read_ratings(spark, str(tmp_path / "bx.zip")).collect()) == [(1, "349224010X", 0.0), (3, "012", 7.0)]
    with zipfile.ZipFile(tmp_path / "other.zip", "w") as z:
        z.writestr("BX-Book-Ratings.csv", "a;b;c\n1;2;3\n")
    with pytest.raises(Exception, match="another header"):
        bookcrossing.read_ratings(spark, str(tmp_path / "other.zip")).collect()


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, t string")
    sinks.write_table(df, str(tmp_path / "t.parquet"), dictionary=("t",))
    info = sinks.table_info(spark, str(tmp_path / "t.parquet"), check_length=True)
    assert info["row_count"] == 2 and [f["name"] for f in info["fields"]] == ["id", "t"] and info["file_size"] > 0
    with pytest.raises(ValueError, match="nulls in t"):
        sinks.write_table(df, str(tmp_path / "u.parquet"), ("t",))
    assert [f.nullable for f in sinks.tightened_schema(df)] == [False, True]
    nodes = spark.createDataFrame([(1, "ISBN", 'x"y'), (2, "LOC", None)], "book_code int, node_type string, label string")
    sinks.write_gml(nodes, spark.createDataFrame([(1, 2)], "src int, dst int"), str(tmp_path / "g.gml"))
    gml = (tmp_path / "g.gml").read_text()
    assert gml.startswith("graph [") and 'label "x&quot;y"' in gml and "source 1\n    target 2" in gml
    sinks.write_csv(df, str(tmp_path / "c"), compressed=False, single=True)
    assert files.read_csv(spark, str(tmp_path / "c"), "id int, t string").count() == 2
    assert sinks.write_metrics(df.agg(F.max("id").alias("m")), str(tmp_path / "m.json")) == {"m": 2}


def test_config():
    c = parse_config("bx:\n  enabled: true\n# note\ngoodreads:\n  enabled: no\naz2018:\n  enabled: true\n  source: reviews\n")
    assert c.is_enabled("bx") and c.is_enabled("AZ18") and not c.is_enabled("goodreads") and not c.is_enabled("az14") and c.is_enabled("loc")
    assert c.options["az2018"]["source"] == "reviews"


def test_whole_run_and_commands(spark, tmp_path):
    raw = tmp_path / "raw"
    for d in ("loc-books", "viaf", "openlibrary", "goodreads", "az2014", "az2018", "bx"):
        (raw / d).mkdir(parents=True)
    (raw / "loc-books/a.xml").write_text("<collection>" + marc_record(1, isbns=["349224010X"], authors=["Berg, Eva"]) + "</collection>")
    (raw / "viaf/v.txt").write_text('1\t<record><leader>l</leader><datafield tag="700" ind1=" " ind2=" "><subfield code="a">Berg, Eva</subfield></datafield><datafield tag="375" ind1=" " ind2=" "><subfield code="a">Female</subfield></datafield></record>\n')
    (raw / "openlibrary/authors.txt").write_text(dump([("/authors/OL2A", {"name": "Eva Berg"})]))
    (raw / "openlibrary/works.txt").write_text(dump([("/works/OL5W", {"title": "W"})]))
    (raw / "openlibrary/editions.txt").write_text(dump([("/books/OL9M", {"isbn_10": ["349224010X"], "works": [{"key": "/works/OL5W"}], "authors": [{"key": "/authors/OL2A"}]})]))
    lines(raw / "goodreads/books.json.gz", BOOKS)
    lines(raw / "goodreads/works.json.gz", [{"work_id": "7", "original_title": "Work", "original_publication_year": "2009", "original_publication_month": ""}])
    lines(raw / "goodreads/authors.json.gz", [{"author_id": "5", "name": "Eva Berg"}])
    lines(raw / "goodreads/genres.json.gz", [{"book_id": "1", "genres": {"a": 1}}])
    lines(raw / "goodreads/interactions.json.gz", [interaction("u", 1, 1, 4), interaction("u", 1, 2, 0), interaction("w", 2, 3, 5)])
    lines(raw / "goodreads/reviews.json.gz", [interaction("u", 1, 1, 4) | {"review_text": "Good", "n_votes": 2}])
    (raw / "az2014/r.csv").write_text("A,349224010X,4.0,100\nA,349224010X,2.0,50\n")
    (raw / "az2018/r.csv").write_text("349224010X,A,4.0,100\n")
    with zipfile.ZipFile(raw / "bx/b.zip", "w") as z:
        z.writestr("BX-Book-Ratings.csv", '"User-ID";"ISBN";"Book-Rating"\n"1";"349224010X";"0"\n"2";"349224010X";"6"\n')
    store = pipeline.Store(spark, str(tmp_path), Config())
    state: dict[str, str] = {}
    assert len(pipeline.run(store, state=state)) == len(pipeline.STAGES)
    assert pipeline.run(store, state=state) == []
    assert [(r.item_id, r.rating, r.n_votes, r.review) for r in store.read("goodreads/reviews").collect()] == [(400000007, 4.0, 2, "Good")]
    assert store.read("goodreads/work_ratings_2015_100_10core").count() == 0 and store.read("goodreads/dataset/interactions").count() == 0
    assert [(r.author_id, r.work_id, r.au_nbooks) for r in store.read("goodreads/author_first_works").orderBy("author_id").collect()] == [(5, 7, 1), (6, 7, 1)]
    work = ids.code_of("OL-W", 5)
    assert {r.isbn: r.cluster for r in store.read("links/isbn_clusters").collect()} == {"349224010X": work, "9780329489391": ids.code_of("GR-B", 2)}
    assert {r.cluster: r.gender for r in store.read("links/cluster_genders").collect()}[work] == "female"
    az = store.read("az2014/cluster_ratings").first()
    assert (az.item_id, az.rating, az.last_rating, az.nratings) == (work, 3.0, 4.0, 2)
    assert store.read("bx/cluster_ratings").count() == 1 and store.read("bx/cluster_actions").count() == 2
    acts = {r.item_id: r.nactions for r in store.read("goodreads/work_actions").collect()}
    assert acts == {400000007: 2, 500000002: 1}
    stats = {(r["dataset"], r["gender"]): r["n_books"] for r in spark.read.csv(str(tmp_path / "links/gender_stats.csv"), header=True).collect()}
    assert stats[("LOC-MDS", "female")] == "1" and stats[("GR-I", "female")] == "1"

    cli.main(["kcore", "-k", "1", "-o", str(tmp_path / "core.parquet"), store.path("az2014/cluster_ratings")], spark)
    assert spark.read.parquet(str(tmp_path / "core.parquet")).count() == 1
    cli.main(["extract-graph", "--graph", store.path("links/clustered"), "--edges", store.path("links/graph_edges"), "-c", str(work), "-o", str(tmp_path / "g.gml")], spark)
    assert (tmp_path / "g.gml").read_text().count("node [") == store.read("links/clustered").where(F.col("cluster") == work).count()
    cli.main(["collect-isbns", "-o", str(tmp_path / "isbns.parquet"), f"A={store.path('loc/isbns')}:isbn", f"G={store.path('goodreads/book_ids')}:isbn10,isbn13"], spark)
    assert spark.read.parquet(str(tmp_path / "isbns.parquet")).count() == 2
    cli.main(["pq-info", "-o", str(tmp_path / "info.json"), store.path("loc/isbns")], spark)
    assert json.loads((tmp_path / "info.json").read_text())["row_count"] == 1

    def command(name: str, *args: str) -> list:
        cli.main([name, "-o", str(tmp_path / f"{name}.parquet"), *args], spark)
        return sorted(map(tuple, spark.read.parquet(str(tmp_path / f"{name}.parquet")).collect()), key=repr)

    def stored(name: str) -> list:
        return sorted(map(tuple, store.read(name).collect()), key=repr)

    path = store.path
    ids_and_names = ("--edition-isbn-ids", path("openlibrary/edition_isbn_ids"), "--edition-authors", path("openlibrary/edition_authors"), "--author-names", path("openlibrary/author_names"))
    records = ("--record-isbn-ids", path("loc/book_isbn_ids"), "--record-authors", path("loc/authors"))
    assert command("extract-authors", "--first", "--clusters", path("links/isbn_clusters"), *ids_and_names, *records) == stored("links/cluster_first_authors")
    people = ("--cluster-authors", path("links/cluster_first_authors"), "--name-index", path("viaf/author_name_index"), "--author-genders", path("viaf/author_genders"))
    assert command("extract-author-gender", "--clusters", path("links/cluster_stats"), *people) == stored("links/cluster_genders")
    assert command("cluster-interactions", "actions", "--native-works", "--books", path("goodreads/book_ids"), path("goodreads/interactions")) == stored("goodreads/work_actions")
    assert command("cluster-interactions", "ratings", "--books", path("goodreads/book_link"), path("goodreads/interactions")) == stored("goodreads/cluster_ratings")
    assert command("work-gender", "--genders", path("links/cluster_genders"), path("goodreads/book_link")) == stored("goodreads/work_gender")
    sinks.write_csv(store.read("bx/ratings"), str(tmp_path / "swaps"), compressed=False)
    assert command("bx-actions", "--clusters", path("links/isbn_clusters"), str(tmp_path / "swaps")) == stored("bx/cluster_actions")
    cli.main(["integration-stats", str(tmp_path)], spark)

    pipeline.save_state(state, str(tmp_path / "state.json"))
    (raw / "az2014/s.csv").write_text("B,349224010X,1.0,70\n")
    assert {"scan-az2014", "collect-isbns", "cluster-az2014"} <= set(pipeline.run(store, state_path=str(tmp_path / "state.json")))
    assert store.read("az2014/cluster_ratings").count() == 2
    assert pipeline.run(store, state_path=str(tmp_path / "state.json")) == []
