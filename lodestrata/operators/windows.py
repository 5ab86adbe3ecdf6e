"""Order-dependent steps of line scanners as windows. Every one is partitioned by a key of bounded groups (a file, a user)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def by(key: str | list[str], order: str | list[str]) -> WindowSpec:
    return Window.partitionBy(*([key] if isinstance(key, str) else key)).orderBy(*([order] if isinstance(order, str) else order))


def upto(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def before(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, -1)


def carry_forward(header: Column, w: WindowSpec, default: str | None = None, strictly: bool = False) -> Column:
    """The last header that is not null, up to this row or strictly before it."""
    last = F.last(header, ignorenulls=True).over(before(w) if strictly else upto(w))
    return last if default is None else F.coalesce(last, F.lit(default))


def running(flag: Column, w: WindowSpec) -> Column:
    """How many rows up to this one have the flag."""
    return F.sum(flag.cast("long")).over(upto(w))


def clamped(df: DataFrame, delta: str, w: WindowSpec, name: str) -> DataFrame:
    """A running sum of `delta` that never falls below 0: the walk less its running minimum, where that is negative."""
    walked = df.withColumn("_walk", F.sum(delta).over(upto(w)))
    low = F.least(F.lit(0), F.min("_walk").over(upto(w)))
    return walked.withColumn(name, F.col("_walk") - low).drop("_walk")


def lookahead(value: Column, n: int, w: WindowSpec) -> Column:
    """The values of the next n rows, as an array."""
    return F.collect_list(value).over(w.rowsBetween(1, n))


def first_wins(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The first row for each key; unlike dropDuplicates it says which."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def adjacent_pairs(values: Column) -> Column:
    """The pairs of neighbours in an array."""
    n = F.size(values)
    pair = lambda i: F.struct(F.element_at(values, i).alias("a"), F.element_at(values, i + 1).alias("b"))
    return F.when(n > 1, F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), pair)).otherwise(F.transform(F.slice(values, 1, 0), lambda x: F.struct(x.alias("a"), x.alias("b"))))


def block_numbers(df: DataFrame, start: Column, end: Column, w: WindowSpec, name: str) -> DataFrame:
    """`df` with the number of the block that a row lies in (from 1 in each group of `w`), null outside.

    A block ends at the first end after its start, or never; a start within an open block is no start. So after a row
    with just one of the flags the state is known, and rows with both turn it over: a parity since the last known state.
    """
    s, e = F.coalesce(start, F.lit(False)), F.coalesce(end, F.lit(False))
    rows = df.withColumns({"_s": s, "_known": F.when(s != e, s), "_turns": F.sum((s & e).cast("long")).over(upto(w))})
    rows = rows.withColumns({"_state": F.last("_known", ignorenulls=True).over(upto(w)), "_since": F.last(F.when(F.col("_known").isNotNull(), F.col("_turns")), ignorenulls=True).over(upto(w))})
    turned = (F.col("_turns") - F.coalesce("_since", F.lit(0))) % 2 == 1
    rows = rows.withColumn("_open", F.coalesce("_state", F.lit(False)) != turned)
    rows = rows.withColumn("_was", F.coalesce(F.lag("_open").over(w), F.lit(False)))
    rows = rows.withColumn("_n", F.sum((F.col("_s") & ~F.col("_was")).cast("long")).over(upto(w)))
    return rows.withColumn(name, F.when(F.col("_s") | F.col("_was"), F.col("_n"))).drop("_s", "_known", "_turns", "_state", "_since", "_open", "_was", "_n")


def blocks(starts: Column, ends: Column) -> Column:
    """(start, end) of the blocks of one file from its sorted arrays of start and end lines.

    A block ends at the first end after its start (null: none); a start within an open block is no start.
    """
    zero = F.struct(F.lit(-1).alias("upto"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))

    def step(s: Column, start: Column) -> Column:
        end = F.array_min(F.filter(ends, lambda e: e > start))
        one = F.array(F.struct(start.alias("start"), end.alias("end")))
        # the last block of a file may have no end; it swallows the rest
        return F.when(start <= s["upto"], s).otherwise(F.struct(F.coalesce(end, F.lit(2**31 - 1)).alias("upto"), F.concat(s["out"], one).alias("out")))

    return F.aggregate(starts, zero, step)["out"]
