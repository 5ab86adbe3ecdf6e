"""Deterministic identifiers: the first 32 hexadecimal digits of a SHA-256 of a natural key."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from lodestrata.functions.text import as_col


def node_id(*parts: Column | str) -> Column:
    """Id of file:line:kind, or of any key written that way; a null part counts as empty."""
    return F.left(F.sha2(F.array_join(F.array(*(F.coalesce(as_col(p).cast("string"), F.lit("")) for p in parts)), ":"), 256), F.lit(32))


def edge_id(kind: str, *key: Column | str) -> Column:
    """Id of an edge: its natural key and its place among edges with the same key, so runs agree."""
    cols = [as_col(k) for k in key]
    place = F.row_number().over(Window.partitionBy(*cols).orderBy(*cols))
    return node_id(F.lit(kind), *cols, place)
