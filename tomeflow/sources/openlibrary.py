"""Dumps of the open catalogue: tab-separated lines whose fifth field is a JSON document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tomeflow.functions.ids import parse_key
from tomeflow.functions.isbn import clean_asin, clean_isbn
from tomeflow.functions.text import clean_name, map_distinct, nfd
from tomeflow.operators.index import in_file_order

#: Least length of an ISBN or ASIN after cleaning.
LEAST_ISBN = 8
#: Kinds of subjects and their letters.
SUBJECTS = {"subjects": "G", "subject_people": "P", "subject_places": "L", "subject_times": "T"}


def read_dump(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``rec_no, key, doc``; a line of fewer than five fields or without JSON is an error."""
    lines = in_file_order(spark.read.text(paths).select("value", "_metadata"), "rec_no")
    parts = F.split("value", "\t", 5)
    doc = F.when(F.size(parts) == 5, F.parse_json(parts[4])).otherwise(F.raise_error(F.concat(F.lit("not a record: "), F.substring("value", 1, 80))))
    return lines.select("rec_no", parts[1].alias("key"), doc.alias("doc"))


def _text(doc: Column, path: str) -> Column:
    return F.try_variant_get(doc, path, "string")


def _list(doc: Column, field: str) -> Column:
    return F.coalesce(F.try_variant_get(doc, f"$.{field}", "array<variant>"), F.array().cast("array<variant>"))


def _is_text(v: Column) -> Column:
    return F.schema_of_variant(v) == "STRING"


def reference_key(v: Column) -> Column:
    """The key in a reference: an object with a key, an object with an author that has one, or a text; else null."""
    return F.coalesce(_text(v, "$.key"), _text(v, "$.author.key"), F.when(_is_text(v), F.variant_get(v, "$", "string")))


def plain_text(v: Column) -> Column:
    """A text, or an object's value."""
    return F.when(_is_text(v), F.variant_get(v, "$", "string")).otherwise(_text(v, "$.value"))


def _authors(records: DataFrame, id_col: str) -> DataFrame:
    """References keep their place in the list even where others are empty."""
    tall = records.select(id_col, F.posexplode(_list(F.col("doc"), "authors")).alias("pos", "a"))
    return tall.select(id_col, F.col("pos").cast("short").alias("pos"), parse_key(reference_key(F.col("a")), "authors").alias("author")).where("author is not null")


def _subjects(records: DataFrame, id_col: str) -> DataFrame:
    kinds = F.array(*[F.struct(F.lit(ord(code)).cast("short").alias("subj_type"), _list(F.col("doc"), field).alias("list")) for field, code in SUBJECTS.items()])
    tall = records.select(id_col, F.explode(kinds).alias("k")).select(id_col, "k.subj_type", F.explode("k.list").alias("s"))
    return tall.select(id_col, "subj_type", plain_text(F.col("s")).alias("subject"))


def author_tables(dump: DataFrame) -> dict[str, DataFrame]:
    """Authors, and their names by source: n the name, p the personal name, a an alternate one."""
    rows = dump.select(parse_key(F.col("key"), "authors").alias("id"), "key", "doc")
    doc = F.col("doc")
    kind = lambda c: F.lit(ord(c)).cast("short").alias("source")
    alternates = F.transform(_list(doc, "alternate_names"), lambda v: F.struct(kind("a"), plain_text(v).alias("raw")))
    every = F.concat(F.array(F.struct(kind("n"), _text(doc, "$.name").alias("raw")), F.struct(kind("p"), _text(doc, "$.personal_name").alias("raw"))), alternates)
    named = rows.select("id", F.explode(every).alias("n")).select("id", "n.*").where("raw is not null")
    return {
        "authors": rows.select("id", "key", nfd(_text(doc, "$.name")).alias("name")),
        "author_names": map_distinct(named, "raw", clean_name, "name").select("id", "source", "name"),
    }


def work_tables(dump: DataFrame) -> dict[str, DataFrame]:
    rows = dump.select(parse_key(F.col("key"), "works").alias("id"), "key", "doc")
    return {"works": rows.select("id", "key", _text(F.col("doc"), "$.title").alias("title")), "work_authors": _authors(rows, "id"), "work_subjects": _subjects(rows, "id")}


def edition_tables(dump: DataFrame, number_by_key: bool = False) -> dict[str, DataFrame]:
    """Editions, numbered by their place in the dump (or by the number in their key), and what they refer to."""
    number = parse_key(F.col("key"), "editions") if number_by_key else F.col("rec_no").cast("int")
    rows = dump.select(number.alias("id"), "key", "doc")
    doc = F.col("doc")
    texts = lambda field, clean: F.transform(_list(doc, field), lambda v: clean(plain_text(v)))
    isbns = rows.select(F.col("id").alias("edition"), F.explode(F.concat(texts("isbn_10", clean_isbn), texts("isbn_13", clean_isbn), texts("asin", clean_asin))).alias("isbn"))
    works = rows.select(F.col("id").alias("edition"), F.explode(_list(doc, "works")).alias("w"))
    return {
        "editions": rows.select("id", "key", _text(doc, "$.title").alias("title")),
        "edition_isbns": isbns.where(F.char_length("isbn") >= LEAST_ISBN),
        "edition_works": works.select("edition", parse_key(_text(F.col("w"), "$.key"), "works").alias("work")),
        "edition_authors": _authors(rows.withColumnRenamed("id", "edition"), "edition"),
        "edition_subjects": _subjects(rows, "id"),
    }
