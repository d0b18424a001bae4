"""Cleaning of strings."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import arrow_udf
from pyspark.sql.types import StringType

#: Unicode white space at either end.
_TRIM = r"(?U)^\s+|\s+$"


def trim_unicode(c: Column) -> Column:
    """Strip all Unicode white space; Spark's own trim strips U+0020 only."""
    return F.regexp_replace(c, _TRIM, "")


def trim_opt(c: Column) -> Column:
    """Trimmed text, null if nothing is left."""
    return F.nullif(trim_unicode(c), F.lit(""))


def parse_opt(c: Column, type_name: str) -> Column:
    """The value of a trimmed text, null if it is empty; other texts are an error."""
    return trim_opt(c).cast(type_name)


def split_first(c: Column, separator: str = "\t") -> tuple[Column, Column]:
    """The text before and after the first separator; both null without one."""
    parts = F.split(c, re.escape(separator), 2)
    found = F.contains(c, F.lit(separator))
    return F.when(found, F.get(parts, F.lit(0))), F.when(found, F.get(parts, F.lit(1)))


#: Unicode white space (str.strip() alone would also strip U+001C to U+001F).
WHITE = "\t\n\v\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def nfd_text(s: str) -> str:
    return s if s.isascii() else unicodedata.normalize("NFD", s)


_UNTIDY = r"[.]|[ \t\n\f\r][ \t\n\f\r,]"
_SLOW = re.compile(_UNTIDY)
_RUN = re.compile(r"[ \t\n\f\r.]+")


def clean_name_text(s: str) -> str:
    """Canonical decomposition, then tidy spaces and full stops.

    A name whose trimmed form has no full stop, no doubled white space and none before a comma is
    only trimmed (of Unicode white space).  In others every run of ASCII white space and full stops
    becomes one space, none of it before a comma or at an end.
    """
    s = nfd_text(s)
    trimmed = s.strip(WHITE)
    if not _SLOW.search(trimmed):
        return trimmed
    s = _RUN.sub(" ", s)
    return s.replace(" ,", ",").strip(" ")


def _over(fn):
    @arrow_udf(StringType())
    def apply(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for values in batches:
            yield pa.array([None if v is None else fn(v) for v in values.to_pylist()], pa.string())

    return apply


def nfd(c: Column) -> Column:
    """Canonical decomposition; Spark has no such function, so one Arrow pass."""
    return _over(nfd_text)(c)


def clean_name(c: Column) -> Column:
    return _over(clean_name_text)(c)


def clean_name_ascii(c: Column) -> Column:
    """:func:`clean_name` for ASCII texts, in the JVM."""
    tidy = F.trim(F.replace(F.regexp_replace(c, r"[ \t\n\f\r.]+", " "), F.lit(" ,"), F.lit(",")))
    return F.when(F.regexp_like(trim_unicode(c), F.lit(_UNTIDY)), tidy).otherwise(trim_unicode(c))


def map_distinct(df: DataFrame, column: str, fn, out: str) -> DataFrame:
    """``df`` with ``fn`` of a column that repeats much: applied once to each distinct value, then joined."""
    values = df.select(column).distinct()
    return df.join(values.withColumn(out, fn(F.col(column))), column, "left")
