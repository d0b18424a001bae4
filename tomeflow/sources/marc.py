"""Catalogue records in MARC-XML."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tomeflow.functions.isbn import parse_isbns
from tomeflow.functions.text import clean_name, map_distinct, trim_unicode
from tomeflow.operators.index import in_file_order

RECORD = (
    "leader string, controlfield array<struct<_tag:string,_VALUE:string>>, "
    "datafield array<struct<_tag:string,_ind1:string,_ind2:string,subfield:array<struct<_code:string,_VALUE:string>>>>"
)
_OPTIONS = {"mode": "FAILFAST", "ignoreSurroundingSpaces": "false", "ignoreNamespace": "true"}


def read_documents(spark: SparkSession, paths: str | list[str], row_tag: str = "record") -> DataFrame:
    """``rec_id, record`` of all records of XML documents, numbered by file and place."""
    reader = spark.read.format("xml").schema(RECORD).options(rowTag=row_tag, **_OPTIONS)
    read = reader.load(paths).select(F.struct("leader", "controlfield", "datafield").alias("record"), "_metadata")
    return in_file_order(read, "rec_id").select("rec_id", "record")


def read_delimited(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``rec_id, record`` of files with an identifier, a tab and a record in each line, numbered by file and line."""
    lines = in_file_order(spark.read.text(paths).select("value", "_metadata"), "rec_id")
    return parse_records(lines.select("rec_id", F.get(F.split("value", "\t", 2), F.lit(1)).alias("xml")))


def parse_records(lines: DataFrame) -> DataFrame:
    """``rec_id, record`` from ``rec_id, xml``; XML that is no record is an error."""
    return lines.select("rec_id", F.from_xml("xml", RECORD, _OPTIONS).alias("record"))


def _code(c: Column) -> Column:
    """A one-character code as its number, 0 if there is none."""
    return F.coalesce(F.ascii(F.substring(c, 1, 1)), F.lit(0)).cast("short")


def flat_fields(records: DataFrame) -> DataFrame:
    """A row for the leader (tag -1), each control field and each subfield, numbered within the record."""
    zero = F.lit(0).cast("short")

    def row(tag: Column, ind1: Column, ind2: Column, code: Column, contents: Column) -> Column:
        return F.struct(tag.cast("short").alias("tag"), ind1.alias("ind1"), ind2.alias("ind2"), code.alias("sf_code"), F.coalesce(contents, F.lit("")).alias("contents"))

    r = F.col("record")
    leader = F.array(row(F.lit(-1), zero, zero, zero, r["leader"]))
    control = F.transform(F.coalesce(r["controlfield"], F.array()), lambda f: row(f["_tag"], zero, zero, zero, f["_VALUE"]))
    data = F.flatten(
        F.transform(
            F.coalesce(r["datafield"], F.array()),
            lambda f: F.transform(F.coalesce(f["subfield"], F.array()), lambda s: row(f["_tag"], _code(f["_ind1"]), _code(f["_ind2"]), _code(s["_code"]), s["_VALUE"])),
        )
    )
    return records.select("rec_id", F.posexplode(F.concat(leader, control, data)).alias("fld_no", "f")).select("rec_id", "fld_no", "f.*")


def filter_fields(fields: DataFrame, tag: int | None = None, subfield: str | None = None, trim: bool = False, lower: bool = False, name: str = "contents") -> DataFrame:
    """``rec_id`` and the contents of some fields; without a tag or subfield, of any."""
    if tag is not None:
        fields = fields.where(F.col("tag") == tag)
    if subfield is not None:
        fields = fields.where(F.col("sf_code") == ord(subfield))
    contents = F.col("contents")
    if trim:
        contents = trim_unicode(contents)
    if lower:
        contents = F.lower(contents)
    return fields.select("rec_id", contents.alias(name))


def _control(tag: str) -> Column:
    fields = F.filter(F.col("record.controlfield"), lambda f: f["_tag"].cast("int") == int(tag))
    return F.get(fields, F.lit(0))["_VALUE"]


def _leader(place: int) -> Column:
    return F.coalesce(F.ascii(F.substring("record.leader", place + 1, 1)), F.lit(0)).cast("short")


def _subfields(tag: int, code: str) -> Column:
    fields = F.filter(F.coalesce(F.col("record.datafield"), F.array()), lambda f: f["_tag"].cast("int") == tag)
    every = F.flatten(F.transform(fields, lambda f: F.coalesce(f["subfield"], F.array())))
    return F.transform(F.filter(every, lambda s: F.substring(s["_code"], 1, 1) == code), lambda s: F.coalesce(s["_VALUE"], F.lit("")))


def is_book() -> Column:
    """Text or manuscript text by the leader, and no government publication by control field 008."""
    kind = F.coalesce(F.substring("record.leader", 7, 1), F.lit(""))
    publication = F.substring(_control("008"), 29, 1)
    return kind.isin("a", "t") & (publication.isNull() | publication.isin("", " ", "|"))


def book_tables(records: DataFrame) -> dict[str, DataFrame]:
    """Fields, identifiers, ISBNs and authors of the records that are books, which are numbered anew in record order.

    A book without control field 001 is an error.  An ISBN has a row for each of its tags.
    """
    from tomeflow.operators.index import dense_index

    books = dense_index(records.where(is_book()), ["rec_id"], "_tf_book").select(F.col("_tf_book").alias("rec_id"), "record")
    number = F.coalesce(_control("001"), F.raise_error(F.lit("a record has no control number")).cast("string"))
    numbers = F.get(_subfields(10, "a"), F.lit(0))
    isbns = books.select("rec_id", F.explode(F.flatten(F.transform(_subfields(20, "a"), parse_isbns))).alias("x"))
    names = books.select("rec_id", F.explode(F.transform(_subfields(100, "a"), trim_unicode)).alias("heading"))
    return {
        "fields": flat_fields(books),
        "ids": books.select(
            "rec_id", trim_unicode(number).alias("marc_cn"), trim_unicode(numbers).alias("lccn"), _leader(5).alias("status"), _leader(6).alias("rec_type"), _leader(7).alias("bib_level")
        ),
        "isbns": isbns.select("rec_id", F.col("x.isbn").alias("isbn"), F.explode_outer("x.tags").alias("tag")),
        "authors": map_distinct(names, "heading", clean_name, "author_name").where("author_name <> ''").select("rec_id", "author_name"),
    }
