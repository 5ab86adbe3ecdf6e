"""Text functions whose results must not depend on locale or Java's defaults."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(x: Column | str) -> Column:
    """Without white space of any kind at both ends; Spark's trim removes blanks only."""
    return F.regexp_replace(as_col(x), r"^\s+|\s+$", "")


def strip_chars(x: Column | str, chars: str) -> Column:
    """Without any of `chars` at both ends."""
    return F.btrim(as_col(x), F.lit(chars))


def group(x: Column | str, pattern: str, n: int = 1) -> Column:
    """The n-th group of the first match; '' where there is none."""
    return F.regexp_extract(as_col(x), pattern, n)


def groups(x: Column | str, pattern: str, n: int = 1) -> Column:
    """The n-th group of every match."""
    return F.regexp_extract_all(as_col(x), F.lit(pattern), F.lit(n))


def matches(x: Column | str, pattern: str) -> Column:
    return as_col(x).rlike(pattern)


def json_map(x: Column | str) -> Column:
    """The values of a JSON object by key; of what is null or no JSON, an empty map."""
    return F.coalesce(F.from_json(as_col(x), "map<string,string>"), F.create_map().cast("map<string,string>"))


def none_if_empty(x: Column) -> Column:
    return F.when(x != "", x)


def joined(rows: Column, separator: str) -> Column:
    """An array of (order, text) structs as one text, in order."""
    return F.array_join(F.transform(F.array_sort(rows), lambda r: r["text"]), separator)


def word(x: Column | str) -> Column:
    """The first word, upper-cased."""
    return F.upper(group(x, r"^\s*(\S+)"))
