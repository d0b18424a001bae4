"""Gender values and their merge.

Values form a lattice: ``unknown`` is below all others, ``ambiguous`` above; two different
values merge to ``ambiguous``.  The merge is associative and commutative, so it is an
aggregate of built-in functions that combines on the map side.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN, AMBIGUOUS = "unknown", "ambiguous"


def parse_gender(c: Column) -> Column:
    """Trimmed and lower-cased; any text is a value."""
    return F.lower(F.trim(c))


def merge_genders(c: Column) -> Column:
    """Aggregate: null for no values at all, else the merged value."""
    # min and max of the known values decide like a distinct count would, without its expansion of rows.
    known = F.when(c != UNKNOWN, c)
    return (
        F.when(F.min(known) != F.max(known), AMBIGUOUS)
        .when(F.min(known).isNotNull(), F.min(known))
        .when(F.count(c) > 0, UNKNOWN)
    )


def cluster_status(n_authors: Column, n_records: Column, gender: Column, is_isbn: Column) -> Column:
    """Gender of a cluster, or the first link that is missing on the way to one."""
    return (
        F.when(F.coalesce(n_authors, F.lit(0)) == 0, F.when(is_isbn, "no-book").otherwise("no-book-author"))
        .when(F.coalesce(n_records, F.lit(0)) == 0, "no-author-rec")
        .when(gender.isNull(), "no-gender")
        .otherwise(gender)
    )
