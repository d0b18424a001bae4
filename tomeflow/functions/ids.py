"""Identifier namespaces, record keys and bit patterns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Width of a namespace.
WIDTH = 100_000_000

# Namespaces and their numbers.
NAMESPACES = {
    "OL-W": 1,
    "OL-E": 2,
    "LOC": 3,
    "GR-W": 4,
    "GR-B": 5,
    "LOC-W": 6,
    "LOC-I": 7,
    "ISBN": 9,
}


def base(namespace: str) -> int:
    return NAMESPACES[namespace] * WIDTH


def code_of(namespace: str, n: int) -> int:
    if not 0 <= n <= WIDTH:
        raise ValueError(f"{n} is outside the namespace {namespace}")
    return base(namespace) + n


def number_of(namespace: str, code: int) -> int | None:
    n = code - base(namespace)
    return n if 0 <= n < WIDTH else None


def namespace_of(code: int) -> str | None:
    return next((name for name, k in NAMESPACES.items() if k == code // WIDTH), None)


def to_code(c: Column, namespace: str) -> Column:
    """Shift numbers into a namespace; they must be in range."""
    checked = F.when((c >= 0) & (c <= WIDTH), c + F.lit(base(namespace))).when(
        c.isNotNull(), F.raise_error(F.concat(F.lit(f"outside the namespace {namespace}: "), c.cast("string")))
    )
    return checked.cast("int")


def in_namespace(c: Column, namespace: str) -> Column:
    """Range test, which reaches Parquet statistics; a division would not."""
    return c.between(base(namespace), base(namespace) + WIDTH - 1)


def from_code(c: Column, namespace: str) -> Column:
    """The number in a namespace, null for codes of others."""
    return F.when(in_namespace(c, namespace), c - F.lit(base(namespace))).cast("int")


def namespace_name(c: Column) -> Column:
    names = F.create_map(*[F.lit(x) for name, k in NAMESPACES.items() for x in (k, name)])
    return F.try_element_at(names, F.floor(c / F.lit(WIDTH)).cast("int"))


def item_code(work: Column, book: Column, compat: bool = False) -> Column:
    """Code of a book's work, else of the book itself; ``compat`` shifts books into the works' namespace."""
    return F.when(work.isNotNull(), to_code(work, "GR-W")).otherwise(to_code(book, "GR-W" if compat else "GR-B"))


#: Key spaces of the open catalogue: the word in the path and the letter at the end.
KEY_SPACES = {"works": "W", "editions": "M", "authors": "A"}


def parse_key(c: Column, space: str) -> Column:
    """The number of a key such as /works/OL38140W; another shape or space is an error.

    The word in the path may be any with the same first letter (/a/OL1A).
    """
    shape = r"^/([a-z]+)/OL([0-9]+)([A-Z])$"
    word, letter = F.regexp_extract(c, shape, 1), F.regexp_extract(c, shape, 3)
    good = word.startswith(space[0]) & (letter == KEY_SPACES[space])
    return F.when(good, F.regexp_extract(c, shape, 2).try_cast("int")).when(
        c.isNotNull(), F.raise_error(F.concat(F.lit("not a key: "), c))
    )


def hex_halves(c: Column) -> tuple[Column, Column]:
    """Two signed 64-bit numbers, big-endian, of 32 hex digits."""
    half = lambda at: F.conv(F.substring(c, at, 16), 16, -10).cast("bigint")
    checked = F.when(F.regexp_like(c, F.lit("^[0-9a-fA-F]{32}$")), F.lit(True)).when(c.isNotNull(), F.raise_error(F.concat(F.lit("not 32 hex digits: "), c)))
    return F.when(checked, half(1)), F.when(checked, half(17))


def hex_xor(c: Column) -> Column:
    hi, lo = hex_halves(c)
    return hi.bitwiseXOR(lo)
