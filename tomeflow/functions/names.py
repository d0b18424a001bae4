"""Names of persons as catalogues write them: parsing and variants."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import arrow_udf
from pyspark.sql.types import ArrayType, StringType

from tomeflow.functions.text import WHITE, clean_name_text

_S = r"[ \n\r\t]*+"
_YEARS = rf"(?>{_S},)?+{_S}\(?+(YEARS[0-9]++-[0-9]*+)\)?+"
_PLAIN, _NAMED = _YEARS.replace("(YEARS", "(?:"), _YEARS.replace("(YEARS", "(?P<years>")
_CLOSE = rf"[,.]{_S}\Z"
_REST = rf"(?:.(?!(?>{_CLOSE}|{_PLAIN})))*+"
_ONLY_YEARS = re.compile(rf"^{_PLAIN}", re.S)
_NAME = re.compile(
    rf"^(?>!!![A-Za-z]++!!!{_S})?+(?>(?P<last>[^,]*+),{_S}(?P<first>{_REST}[^,]?+)|(?P<single>{_REST}[^,.]?+))(?>{_CLOSE}|{_NAMED})?+",
    re.S,
)


def parse_name(text: str) -> tuple[str | None, str | None, str | None]:
    """``(last, first, years)`` of an entry; a name of one part has no last part, and no part is empty."""
    if _ONLY_YEARS.match(text):
        return None, None, None
    m = _NAME.match(text)
    if m is None:
        raise ValueError(f"no name in {text!r}")
    years = m["years"]
    if m["last"] is None:
        return None, m["single"].strip(WHITE) or None, years
    last, first = m["last"].strip(WHITE), m["first"].strip(WHITE)
    return (last, first, years) if last and first else (None, last or first or None, years)


def name_variants_of(text: str) -> list[str]:
    """Cleaned forms of a name in both orders, without and with its years; sorted, each once."""
    last, first, years = parse_name(text)
    forms = [f"{first} {last}", f"{last}, {first}"] if last else [first] if first else []
    if years:
        forms += [f"{f}, {years}" for f in forms]
    return sorted({clean_name_text(f) for f in forms}, key=lambda s: s.encode())


@arrow_udf(ArrayType(StringType()))
def _variants(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for names in batches:
        yield pa.array([None if n is None else name_variants_of(n) for n in names.to_pylist()], pa.list_(pa.string()))


def name_variants(c: Column) -> Column:
    """``array<string>`` of a name's variants; an entry that holds no name at all is an error."""
    return _variants(c)


def index_names(fields: DataFrame, rec_col: str = "rec_id", name_col: str = "contents") -> DataFrame:
    """``rec_id, name``: every variant of every authority name, in the order of names, then records.

    Each distinct heading is parsed once; headings repeat across records.
    """
    headings = fields.select(F.col(name_col).alias("heading")).where("heading is not null").distinct()
    variants = headings.select("heading", F.explode(name_variants(F.col("heading"))).alias("name"))
    return (
        fields.select(F.col(rec_col).alias("rec_id"), F.col(name_col).alias("heading"))
        .join(variants, "heading")
        .select("rec_id", "name")
        .distinct()
        .orderBy("name", "rec_id")
    )
