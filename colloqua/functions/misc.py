"""Small expressions: display of sizes and durations, keys inside names, log lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNITS = ("B", "KB", "MB", "GB", "TB", "PB")


def size_text(size: Column) -> Column:
    """fn23: bytes in the first unit that leaves less than 1024 of it; whole bytes, else one decimal, ties to even."""
    scaled = lambda power: F.bround(size / F.lit(float(1024**power)), 1)
    out = F.format_string(f"%.1f {UNITS[-1]}", scaled(len(UNITS) - 1))
    for power in range(len(UNITS) - 2, 0, -1):
        out = F.when(size < float(1024 ** (power + 1)), F.format_string(f"%.1f {UNITS[power]}", scaled(power))).otherwise(out)
    whole = F.concat(size.cast("long").cast("string"), F.lit(f" {UNITS[0]}"))
    return F.when(size < 1024, whole).when(size.isNotNull(), out)


def duration_text(seconds: Column) -> Column:
    """fn23: seconds as ``1小时2分3秒`` without parts that are zero; ``0秒`` for none and for negative ones."""
    whole = F.greatest(seconds.cast("long"), F.lit(0))
    parts = ((F.floor(whole / F.lit(3600)), "小时"), (F.floor(whole / F.lit(60)) % 60, "分"), (whole % 60, "秒"))
    shown = F.concat(*[F.when(n > 0, F.concat(n.cast("string"), F.lit(unit))).otherwise("") for n, unit in parts])
    return F.when(seconds.isNotNull(), F.when(shown == "", "0秒").otherwise(shown))


def name_version(requirement: Column) -> Column:
    """fn27: ``struct<name, version>`` of ``name==version``; without a version it is null."""
    return F.struct(
        F.split_part(requirement, F.lit("=="), F.lit(1)).alias("name"),
        F.nullif(F.split_part(requirement, F.lit("=="), F.lit(2)), F.lit("")).alias("version"),
    )


def number_at_end(name: Column) -> Column:
    """The number a name ends with, or null."""
    return F.regexp_extract(name, r"(\d+)$", 1).try_cast("long")


def layer_key(module: Column) -> Column:
    """fn26: the layer a module name belongs to (``layers.3``, ``h.3``), or null."""
    return F.nullif(F.regexp_extract(module, r"(layers\.\d+|h\.\d+)", 1), F.lit(""))


def training_log(line: Column) -> Column:
    """fn22: ``struct<loss, step>`` that a line of a training log tells; null where it tells none."""
    found = lambda pattern, kind: F.nullif(F.regexp_extract(line, pattern, 1), F.lit("")).try_cast(kind)
    return F.struct(found(r"train_loss:\s*([\d.]+)", "double").alias("loss"), found(r"step:\s*(\d+)", "int").alias("step"))


def ordered_distinct(values: Column) -> Column:
    """U-6: an array without repeats, each value at its first place."""
    return F.array_distinct(values)


def column_width(df: DataFrame, column: str, least: int = 0) -> DataFrame:
    """``width``: the longest text of a column, ``least`` at least."""
    return df.agg(F.greatest(F.coalesce(F.max(F.length(column)), F.lit(0)), F.lit(least)).alias("width"))
