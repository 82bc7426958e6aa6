"""Column functions that several operators use; all built-in, none in Python."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(x: Column) -> Column:
    """Without white space of any kind at both ends (trim() takes blanks alone)."""
    return F.regexp_replace(F.regexp_replace(x, "^\\s+", ""), "\\s+$", "")


def ordered(key, *values) -> Column:
    """A list of structs in order of key, whatever order the rows come in."""
    return F.array_sort(F.collect_list(F.struct(key, *values)))


def ordered_join(key: str, value: str, sep: str) -> Column:
    """The values in order of key, joined."""
    return F.array_join(F.transform(ordered(F.col(key).alias("k"), F.col(value).alias("v")), lambda x: x["v"]), sep)


def ordered_values(key: str, value: str) -> Column:
    return F.transform(ordered(F.col(key).alias("k"), F.col(value).alias("v")), lambda x: x["v"])


def ratio(a: Column, b: Column, digits: int = 6) -> Column:
    """a / b rounded; 0 where b is 0."""
    return F.round(F.when(b == 0, 0.0).otherwise(a.cast("double") / b.cast("double")), digits)


def slug(x: Column, most: int = 40) -> Column:
    return F.btrim(F.substring(F.btrim(F.regexp_replace(F.lower(x), "[^a-z0-9]+", "_"), F.lit("_")), 1, most), F.lit("_"))
