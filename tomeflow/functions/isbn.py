"""ISBN and ASIN cleaning, and the grammar of ISBN fields in catalogue records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tomeflow.functions.text import trim_unicode


def clean_isbn(c: Column) -> Column:
    """Digits and X; a small x and the letter O are read as X and 0."""
    return F.regexp_replace(F.translate(c, "xO", "X0"), "[^0-9X]", "")


def clean_asin(c: Column) -> Column:
    """ASCII letters and digits, in upper case."""
    return F.upper(F.regexp_replace(c, "[^0-9A-Za-z]", ""))


def clean_rating_isbn(c: Column) -> Column:
    """Upper case first, then digits and X; the letter O goes."""
    return F.regexp_replace(F.upper(c), "[^0-9X]", "")


# The grammar has ordered choice without backtracking, hence possessive quantifiers and atomic groups.
_SPACE = r"[ \n\r\t]"
_LEAD = rf"[;.]?+{_SPACE}*+(?>[a-z]{_SPACE}++|\([0-9]++\){_SPACE}++|\*|ISBN{_SPACE}++)?+"
_TEXT = r"(?>[0-9\-O\p{Mn}]{8,}+[Xx]?+|[0-9]{1,5}+(?>[a-zA-Z]++|[ +])[0-9\-]{4,}+)"
_TAGS = rf"(?>{_SPACE}*+[\[(](?>[^:)\]]++(?>:[^:)\]]++)*+)?+[\])])*+"
ISBN_PATTERN = rf"(?:^|\G(?!^){_SPACE}*+[;:/.]?+){_LEAD}({_TEXT})({_TAGS})"

# Patterns of fields that hold no ISBN and are no surprise.
IGNORED = (
    r"^[$]?[\d., ]+(?:[a-zA-Z*]{1,4})?(\s+\(.*?\))?$",
    r"^[\d.]+(/[\d.]+)+$",
    r"^[A-Z]-[A-Z]-\d{8,}",
    r"^\s*$",
)


def parse_isbns(c: Column) -> Column:
    """``array<struct<isbn, tags array<string>>>`` of a field's ISBNs, in order; empty if none match."""
    texts = F.regexp_extract_all(c, F.lit(ISBN_PATTERN), F.lit(1))
    groups = F.regexp_extract_all(c, F.lit(ISBN_PATTERN), F.lit(2))

    def tags(group: Column) -> Column:
        inside = F.filter(F.regexp_extract_all(group, F.lit(r"[\[(]([^)\]]*)[\])]"), F.lit(1)), lambda s: s != "")
        return F.flatten(F.transform(inside, lambda s: F.transform(F.split(s, ":"), trim_unicode)))

    return F.transform(
        F.arrays_zip(texts.alias("t"), groups.alias("g")),
        lambda m: F.struct(clean_isbn(m["t"]).alias("isbn"), tags(m["g"]).alias("tags")),
    )


def ignored_isbn(c: Column) -> Column:
    out = F.lit(False)
    for pattern in IGNORED:
        out = out | F.regexp_like(c, F.lit(pattern))
    return out


def isbn_status(c: Column) -> Column:
    """``valid``, ``ignored`` or ``unmatched``."""
    return F.when(F.size(parse_isbns(c)) > 0, "valid").when(ignored_isbn(c), "ignored").otherwise("unmatched")
