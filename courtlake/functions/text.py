"""Text, key and map access."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from courtlake.functions.numbers import ColumnLike, _col

# The characters Python counts as white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip_text(text: ColumnLike, null_text: str | None = None) -> Column:
    """Trim white space on both sides.

    ``null_text="None"`` gives the text a missing value becomes when it is
    stringified before the trim; by default null stays null.
    """
    c = _col(text)
    if null_text is not None:
        c = F.coalesce(c, F.lit(null_text))
    return F.btrim(c, F.lit(WHITE_SPACE))


def key_from_path(path: ColumnLike) -> Column:
    """Base name of a document path without its ending ``.json``."""
    return F.regexp_replace(F.substring_index(_col(path), "/", -1), r"\.json$", "")


def get_or_default(mapping: ColumnLike, key: str, default: str = "") -> Column:
    """Value of a map key; the default only when the key is absent, so an explicit null stays."""
    m = _col(mapping)
    return F.when(F.map_contains_key(m, F.lit(key)), m[key]).otherwise(F.lit(default))


def or_empty(array: ColumnLike) -> Column:
    """The array, or an empty one of the same type when it is missing."""
    return F.coalesce(_col(array), F.array())


def extras(mapping: ColumnLike, declared: list[str]) -> Column:
    """Entries of a map whose keys are not declared columns."""
    known = F.array(*[F.lit(k) for k in declared])
    return F.map_filter(_col(mapping), lambda k, _: ~F.array_contains(known, k))
