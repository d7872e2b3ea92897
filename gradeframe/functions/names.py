"""String helpers for member names and dimension lookups."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def capitalize_first(s: Column) -> Column:
    """Upper-case the first character only (``initcap`` would touch every word)."""
    return F.concat(F.upper(F.substring(s, 1, 1)), F.substring(s, F.lit(2), F.length(s)))


def full_name(first: Column, last: Column, capitalize: bool = False) -> Column:
    """``first + " " + last`` with NULL parts as empty strings."""
    f = F.coalesce(first, F.lit(""))
    if capitalize:
        f = capitalize_first(f)
    return F.concat(f, F.lit(" "), F.coalesce(last, F.lit("")))


def name_matches(col: Column, name: str) -> Column:
    """Case-insensitive equality with a user-given name."""
    return F.lower(col) == F.lit(name.lower())
