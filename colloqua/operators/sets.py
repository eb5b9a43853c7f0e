"""Unions, exact samples, deduplication, caps, chunks and nearest matches over records."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colloqua.session import staged


def canonical_json(record: Column) -> Column:
    """Records as JSON with sorted keys at all levels, for comparison; a text that isn't JSON as it is, null as null.

    Values are compared as the reference does, so 1, 1.0 and "1" differ, which a
    variant doesn't keep apart (its decimals lose trailing zeros).
    """

    @F.pandas_udf("string")
    def canonical(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([_sorted_keys(t) for t in texts.tolist()], dtype=object)

    return canonical(record)


def _sorted_keys(text: str | None) -> str | None:
    if text is None:
        return None
    try:
        return json.dumps(json.loads(text), sort_keys=True)
    except (ValueError, RecursionError):
        return text


def keep_first(df: DataFrame, identity: Column, order: list[Column]) -> DataFrame:
    """The first row, by ``order``, of each identity; a null identity is one like any other.

    Ranked with a group limit before the exchange, so copies don't travel.
    """
    keyed = df.withColumn("__id", identity)
    w = Window.partitionBy("__id").orderBy(*order)
    return keyed.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__id", "__rank")


def merge_records(frames: list[DataFrame], dedupe: Column | None = None, order: list[str] = ()) -> DataFrame:
    """U-5: union of frames by name, missing columns null; with ``dedupe``, the first copy by frame and ``order``."""
    ranked = [f.withColumn("__file", F.lit(i)) for i, f in enumerate(frames)]
    whole = ranked[0]
    for frame in ranked[1:]:
        whole = whole.unionByName(frame, allowMissingColumns=True)
    if dedupe is not None:
        whole = keep_first(whole, dedupe, [F.col("__file"), *map(F.col, order)])
    return whole.drop("__file")


def mix_size(n_original: int, percentage: float, n_new: int) -> int:
    """How many new records an exact percentage takes: at least one, at most all there are."""
    return min(max(1, int(n_original * percentage / 100)), n_new)


def hash_order(key: Column, seed: int) -> Column:
    return F.md5(F.concat(key.cast("string"), F.lit(f"|{seed}")))


def mix_by_percentage(original: DataFrame, new: DataFrame, key: str, percentage: float, seed: int = 42) -> DataFrame:
    """U-4: all original records and an exact share of new ones, chosen by hash order.

    Only two counts come to the driver; the choice is a distributed top-k.
    """
    k = mix_size(original.count(), percentage, new.count())
    chosen = new.orderBy(hash_order(F.col(key), seed), F.col(key)).limit(k)
    return original.unionByName(chosen, allowMissingColumns=True)


def shuffled(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """A reproducible order that looks random."""
    return df.orderBy(hash_order(F.col(key), seed), F.col(key))


def mix_all(original: DataFrame, new: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """U-3: all records of both, in an order that looks random."""
    return shuffled(original.unionByName(new, allowMissingColumns=True), key, seed)


def cap_per_group(df: DataFrame, group: str, order: list[str], most: int, always: Column | None = None) -> DataFrame:
    """At most ``most`` rows of a group in ``order``; rows with ``always`` come besides."""
    free = F.lit(False) if always is None else F.coalesce(always, F.lit(False))
    w = Window.partitionBy(group).orderBy(*order)
    capped = df.where(~free).withColumn("__k", F.row_number().over(w)).where(F.col("__k") <= most).drop("__k")
    return capped if always is None else capped.unionByName(df.where(free))


def numbered(df: DataFrame, order: list[str], to: str = "idx") -> DataFrame:
    """Rows numbered from 0 over the whole table by ``order``, which has to be unique for a defined result.

    Sorted by ranges and written once; a row's number is its place in its range
    plus the rows of the ranges before, of which there are as many as tasks.
    """
    ranges = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = staged(ranges.withColumn("__p", F.spark_partition_id()).withColumn("__i", F.monotonically_increasing_id()), "numbered")
    counts = rows.groupBy("__p").agg(F.count("*").alias("__n"), F.min("__i").alias("__first"))
    w = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("__p").alias("__q"), "__first", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__before"))
    joined = rows.join(F.broadcast(offsets), F.col("__p") == F.col("__q"))  # a row for each task of the sort
    return joined.withColumn(to, F.col("__i") - F.col("__first") + F.col("__before")).drop("__p", "__i", "__q", "__first", "__before")


def chunked(df: DataFrame, order: list[str], size: int, group: str | None = None, to: str = "chunk") -> DataFrame:
    """U-8: consecutive chunks of ``size`` rows, numbered from 0, in each ``group`` or over the whole table.

    All rows are numbered in one sort by ranges, which splits a hot group; a
    group's rows stand next to each other there, so that a row's place in its
    group is its number less the group's least.
    """
    if group is None:
        return numbered(df, order, "__idx").withColumn(to, F.floor(F.col("__idx") / F.lit(size)).cast("long")).drop("__idx")
    rows = numbered(df, [group, *order], "__idx")
    first = rows.groupBy(group).agg(F.min("__idx").alias("__least")).withColumnRenamed(group, "__group")
    joined = rows.join(first, F.col(group).eqNullSafe(F.col("__group")))
    return joined.withColumn(to, F.floor((F.col("__idx") - F.col("__least")) / F.lit(size)).cast("long")).drop("__idx", "__least", "__group")


def first_rows(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows by ``order``, a distributed top-k; for the last ones give the order reversed."""
    return df.orderBy(*order).limit(n)


def nearest(value: Column, candidates: list[float]) -> Column:
    """The candidate closest to ``value``; of equally close ones the first."""
    listed = F.array(*[F.lit(c) for c in candidates])
    ranked = F.transform(listed, lambda c, i: F.struct(F.abs(c - value).alias("d"), i.alias("i"), c.alias("c")))
    return F.when(value.isNotNull(), F.array_min(ranked)["c"])


def record_stats(df: DataFrame, text: str) -> DataFrame:
    """A10: number of records, and whole average length of those with a text."""
    n = F.count("*")
    return df.agg(n.alias("n_records"), F.expr(f"CASE WHEN count(*) > 0 THEN coalesce(sum(length({text})), 0) div count(*) END").alias("avg_length"))
