"""Sizes, completeness and contents of folders of model files, over a listing of files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Files that make a model folder complete.
CONFIGS = ("config.json", "configuration.json")
WEIGHTS = ("pytorch_model.bin", "model.safetensors", "pytorch_model.safetensors")


def is_model_file(name: Column) -> Column:
    """Files of a model folder worth listing."""
    return name.rlike(r"\.(json|bin|safetensors|txt)")


def with_folders(files: DataFrame, base: str, path: str = "path") -> DataFrame:
    """``files`` with ``folder``, the first step below ``base``, and ``name``, the rest; files right in ``base`` are left out."""
    inside = F.regexp_replace(F.col(path), "^(file:)?/*", "/")
    root = "/" + base.removeprefix("file:").strip("/") + "/"
    rest = F.when(F.startswith(inside, F.lit(root)), F.substring(inside, F.lit(len(root) + 1), F.length(inside)))
    split = F.split(rest, "/", 2)
    return files.withColumns({"folder": F.try_element_at(split, F.lit(1)), "name": F.try_element_at(split, F.lit(2))}).where("name IS NOT NULL")


def roll_up(files: DataFrame, folder: str = "folder", name: str = "name", size: str = "length") -> DataFrame:
    """``folder, n_files, size, complete`` of each folder of files.

    A folder is complete if a configuration and weights, whole or in parts, lie
    right in it. A null size counts 0. One aggregation, reduced before the shuffle.
    """
    flat = F.coalesce(F.col(name), F.lit(""))
    part = flat.rlike(r"^model-[^/]*\.safetensors$")
    return files.groupBy(folder).agg(
        F.count("*").alias("n_files"),
        F.coalesce(F.sum(size), F.lit(0)).cast("long").alias("size"),
        (F.max(flat.isin(*CONFIGS)) & F.max(flat.isin(*WEIGHTS) | part)).alias("complete"),
    )


def latest(files: DataFrame, path: str = "path", time: str = "modificationTime") -> DataFrame:
    """``path`` of the newest file or folder; of equally new ones the last by name. Null times are oldest."""
    return files.agg(F.max_by(path, F.struct(F.coalesce(F.col(time).cast("timestamp"), F.timestamp_seconds(F.lit(0))), path)).alias(path))


def main_files(files: DataFrame, most: int = 10, folder: str = "folder", name: str = "name") -> DataFrame:
    """The first ``most`` files worth listing of each folder, by name, with ``more``: how many follow."""
    listed = files.where(is_model_file(F.col(name)))
    counts = listed.groupBy(folder).agg(F.greatest(F.count("*") - most, F.lit(0)).alias("more"))
    rank = F.row_number().over(Window.partitionBy(folder).orderBy(name))
    first = listed.withColumn("__rank", rank).where(F.col("__rank") <= most).drop("__rank")
    return first.join(counts.withColumnRenamed(folder, "__folder"), F.col(folder).eqNullSafe(F.col("__folder"))).drop("__folder")
