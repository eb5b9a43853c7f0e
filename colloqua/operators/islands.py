"""Gaps and islands that survive hot keys.

A plain lag window puts all rows of a key into one task. Here each key is cut
into time blocks first: neighbours are compared inside a block, and only the
first and last island of each block go to a second window over the whole key.
Their number is bounded by the time span over the block length, whatever the
number of rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def blocked_islands(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    block: Column,
    edge: list[str],
    joins: Callable[[Column, Column], Column],
    aggs: dict[str, tuple[Column, Callable[[Column], Column]]],
) -> DataFrame:
    """One row for each longest run of neighbours that ``joins`` links.

    keys    columns that separate sequences (null is a key like any other)
    order   columns that order a sequence, unique in it for a defined result
    block   monotone in ``order``: the block of a row
    edge    columns ``joins`` needs of the rows at an island's ends
    joins   (previous row, row) -> boolean; null counts as false
    aggs    name -> (aggregate over rows, merge of partial aggregates)

    The result has ``keys``, ``aggs`` and the structs ``first`` and ``last``
    with ``order`` and ``edge`` of the island's first and last row.
    """
    cols = list(dict.fromkeys([*order, *edge]))
    rows = df.withColumn("__blk", block).withColumn("__row", F.struct(*cols))
    w = Window.partitionBy(*keys, "__blk").orderBy(*order)
    rows = rows.withColumn("__prev", F.lag("__row").over(w))
    linked = F.coalesce(joins(F.col("__prev"), F.col("__row")), F.lit(False))
    rows = rows.withColumn("__brk", F.when(F.col("__prev").isNotNull() & linked, 0).otherwise(1))
    rows = rows.withColumn("__lid", F.sum("__brk").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    by = F.struct(*order)
    parts = rows.groupBy(*keys, "__blk", "__lid").agg(
        F.min_by("__row", by).alias("__first"),
        F.max_by("__row", by).alias("__last"),
        *[first.alias(name) for name, (first, _) in aggs.items()],
    )
    whole = Window.partitionBy(*keys, "__blk")
    parts = parts.withColumn("__inner", (F.col("__lid") > 1) & (F.col("__lid") < F.max("__lid").over(whole)))
    parts = parts.withColumn("__ib", F.when(F.col("__inner"), F.col("__blk"))).withColumn(
        "__il", F.when(F.col("__inner"), F.col("__lid"))
    )
    w2 = Window.partitionBy(*keys, "__ib", "__il").orderBy("__blk", "__lid")
    parts = parts.withColumn("__before", F.lag("__last").over(w2))
    linked = F.coalesce(joins(F.col("__before"), F.col("__first")), F.lit(False)) & (F.col("__lid") == 1)
    parts = parts.withColumn("__brk", F.when(F.col("__before").isNotNull() & linked, 0).otherwise(1))
    parts = parts.withColumn("__gid", F.sum("__brk").over(w2.rowsBetween(Window.unboundedPreceding, 0)))
    at = F.struct("__blk", "__lid")
    return (
        parts.groupBy(*keys, "__ib", "__il", "__gid")
        .agg(
            F.min_by("__first", at).alias("first"),
            F.max_by("__last", at).alias("last"),
            *[merge(F.col(name)).alias(name) for name, (_, merge) in aggs.items()],
        )
        .drop("__ib", "__il", "__gid")
    )
