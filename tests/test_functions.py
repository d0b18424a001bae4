"""Cleaning, parsing and identifier functions: example tables and properties."""

import random
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tomeflow.functions import dates, gender, ids, isbn, names, text


def column(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in df.select("i", fn(F.col("v")).alias("x")).orderBy("i").collect()]


ISBNS = {
    "": [],
    "  ": [],
    "349224010X": [("349224010X", [])],
    "349224010X :": [("349224010X", [])],
    "349̌224010X": [("349224010X", [])],
    "978-03-2948-9391": [("9780329489391", [])],
    "978 032948-9391": [("9780329489391", [])],
    "34922401038 (set)": [("34922401038", ["set"])],
    "34922401038 [set]": [("34922401038", ["set"])],
    "34922401038 (set : alk. paper)": [("34922401038", ["set", "alk. paper"])],
    "34922401038 (pbk.) (set)": [("34922401038", ["pbk.", "set"])],
    "a 970238408138": [("970238408138", [])],
    "970238408138 30148100103": [("970238408138", []), ("30148100103", [])],
    "970238408138; ISBN 30148100103": [("970238408138", []), ("30148100103", [])],
    "8719359022. ISBN 8719359004 (pbk.)": [("8719359022", []), ("8719359004", ["pbk."])],
    "95l3512401 :": [("953512401", [])],
    "O882970208 (pbk.)": [("0882970208", ["pbk."])],
}


def test_isbn_fields(spark):
    got = column(spark, list(ISBNS), isbn.parse_isbns)
    assert [[(x.isbn, x.tags) for x in row] for row in got] == list(ISBNS.values())


def test_isbn_status_and_cleaning(spark):
    assert column(spark, ["", "$12.50", "12.5/13", "349224010X", "nothing here", "A-B-12345678"], isbn.isbn_status) == ["ignored", "ignored", "ignored", "valid", "unmatched", "ignored"]
    assert column(spark, ["0-8O4x", None], isbn.clean_isbn) == ["0804X", None]
    assert column(spark, ["b00-abc!", "é1"], isbn.clean_asin) == ["B00ABC", "1"]
    assert column(spark, ["08o4x", "8;X"], isbn.clean_rating_isbn) == ["084X", "8X"]


VARIANTS = {
    "Mary Sumner": {"Mary Sumner"},
    "Mary Sumner.": {"Mary Sumner"},
    "Sequeira Moreno, Francisco": {"Sequeira Moreno, Francisco", "Francisco Sequeira Moreno"},
    "Jomaa-Raad, Wafa,": {"Wafa Jomaa-Raad", "Jomaa-Raad, Wafa"},
    "Morgan, Michelle, 1967-": {"Morgan, Michelle, 1967-", "Morgan, Michelle", "Michelle Morgan", "Michelle Morgan, 1967-"},
    "Ditlev Reventlow (1712-1783)": {"Ditlev Reventlow, 1712-1783", "Ditlev Reventlow"},
    "Miller, Pat Zietlow,": {"Pat Zietlow Miller", "Miller, Pat Zietlow"},
    "Miller, Pat Zietlow,.": {"Pat Zietlow Miller", "Miller, Pat Zietlow"},
    "Manopoly,": {"Manopoly"},
    "!!!GESPERRT!!!Moro, Simone": {"Simone Moro", "Moro, Simone"},
    "Navarro, P.": {"Navarro, P", "P Navarro"},
    ", Engelbert": {"Engelbert"},
    "1941-": set(),
}


def test_name_variants(spark):
    got = column(spark, [*VARIANTS, None], names.name_variants)
    assert got[-1] is None
    assert [set(v) for v in got[:-1]] == list(VARIANTS.values())
    assert all(v == sorted(v) for v in got[:-1])


CLEAN = {
    "W. Seiler": "W Seiler",
    "Zaphod  Beeblebrox": "Zaphod Beeblebrox",
    "Bob J.": "Bob J",
    "Jones Jr., Albert": "Jones Jr, Albert",
    "  Bob., Qbert. ": "Bob, Qbert",
    "　Li Bai ": "Li Bai",
    "one\ttab": "one\ttab",
    "two\t\ttabs": "two tabs",
    "a , b": "a, b",
    "": "",
}


def test_clean_name(spark):
    assert column(spark, list(CLEAN), text.clean_name) == list(CLEAN.values())
    ascii_only = [k for k in CLEAN if k.isascii()]
    assert column(spark, ascii_only, text.clean_name_ascii) == [CLEAN[k] for k in ascii_only]
    assert column(spark, ["metäl", "", None, "foo"], text.nfd) == ["metäl", "", None, "foo"]


@given(st.text(alphabet=" .,\t\nabé　", max_size=12))
@settings(max_examples=300, deadline=None)
def test_clean_name_is_stable(s):
    once = text.clean_name_text(s)
    assert unicodedata.is_normalized("NFD", once)
    if not any(c in once for c in "\t\n　"):
        assert text.clean_name_text(once) in (once, once.strip())


@given(st.text(alphabet="ab,. (-)19!", max_size=14))
@settings(max_examples=300, deadline=None)
def test_any_name_parses(s):
    last, first, years = names.parse_name(s)
    assert last is None or first is not None
    assert all(p == p.strip() and p for p in (last, first) if p is not None)


def test_scalars(spark):
    assert column(spark, [" x ", " 　", "", None], text.trim_opt) == ["x", None, None, None]
    assert column(spark, [" 12 ", ""], lambda c: text.parse_opt(c, "int")) == [12, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        column(spark, ["x"], lambda c: text.parse_opt(c, "int"))
    split = lambda c: F.array(*text.split_first(c))
    assert column(spark, ["", "foo\tbar", "foo\t", "foo\tbar\tblatz"], split) == [[None, None], ["foo", "bar"], ["foo", ""], ["foo", "bar\tblatz"]]
    halves = lambda c: F.array(*ids.hex_halves(c))
    assert column(spark, ["0" * 32, "80000000000000000000000000000001"], halves) == [[0, 0], [-(2**63), 1]]
    assert column(spark, ["80000000000000000000000000000001", None], ids.hex_xor) == [-(2**63) + 1, None]
    with pytest.raises(Exception, match="not 32 hex digits"):
        column(spark, ["12"], ids.hex_xor)


def test_dates(spark):
    when = ["Tue Oct 03 10:28:16 -0700 2017", "Tuesday October 03 10:28:16 -0700 2017", None]
    assert column(spark, when, lambda c: F.unix_timestamp(dates.parse_feed_date(c))) == [1507051696, 1507051696, None]
    assert column(spark, when, lambda c: dates.float_seconds_to_long(dates.feed_seconds(c))) == [1507051648, 1507051648, None]
    assert dates.year_range(1970) == (0, 365 * 86400)


def test_keys(spark):
    assert column(spark, ["/works/OL38140W", "/w/OL1W", None], lambda c: ids.parse_key(c, "works")) == [38140, 1, None]
    for bad in ("/works/OL1A", "/authors/OL1W", "works/OL1W", ""):
        with pytest.raises(Exception, match="not a key"):
            column(spark, [bad], lambda c: ids.parse_key(c, "works"))


@given(st.integers(0, ids.WIDTH - 1), st.sampled_from(list(ids.NAMESPACES)))
def test_codes_round_trip(n, namespace):
    code = ids.code_of(namespace, n)
    assert ids.namespace_of(code) == namespace and ids.number_of(namespace, code) == n
    assert all(ids.number_of(other, code) is None for other in ids.NAMESPACES if other != namespace)
    assert code < 2**31


def test_code_columns(spark):
    codes = [ids.code_of("LOC", 42), ids.code_of("ISBN", 0), 800_000_001, None]
    assert column(spark, codes, lambda c: ids.from_code(c, "LOC"), "int") == [42, None, None, None]
    assert column(spark, codes, ids.namespace_name, "int") == ["LOC", "ISBN", None, None]
    assert column(spark, [5], lambda c: ids.to_code(c, "GR-B"), "int") == [500_000_005]
    with pytest.raises(Exception, match="outside the namespace"):
        column(spark, [-1], lambda c: ids.to_code(c, "GR-B"), "int")


def merged(values):
    known = {v for v in values if v != "unknown"}
    return None if not values else "unknown" if not known else known.pop() if len(known) == 1 else "ambiguous"


def test_gender_merge(spark):
    rng = random.Random(1)
    bags = [[], ["female"], ["male"], ["male", "female"], ["female", "female"], ["unknown"], ["unknown", "male"], ["ambiguous", "male"], [""], ["", "x"]]
    bags += [[rng.choice(["male", "female", "unknown", "ambiguous", "other"]) for _ in range(rng.randrange(4))] for _ in range(40)]
    rows = [(i, v) for i, bag in enumerate(bags) for v in bag or [None]]
    got = spark.createDataFrame(rows, "i int, v string").groupBy("i").agg(gender.merge_genders(F.col("v")).alias("g")).orderBy("i").collect()
    assert [r.g for r in got] == [merged(b) for b in bags]
    assert column(spark, [" Female ", "X"], gender.parse_gender) == ["female", "x"]
