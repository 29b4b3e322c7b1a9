"""Keep-first duplicates and groups of equal files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def flag_repeats(df: DataFrame, key: str, order: list[str], name: str = "is_repeat") -> DataFrame:
    """``df`` with a flag for all but the first row of each key in the given (unique) order; null keys are never repeats.
    The first rows come from a map-side combined aggregation and meet their rows on key and order together, so a key that
    holds a third of all rows burdens no task."""
    first = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*order)).alias("_f")).select(key, *[F.col(f"_f.{o}").alias(o) for o in order], F.lit(True).alias("_first"))
    return df.join(first, [key, *order], "left").withColumn(name, F.col(key).isNotNull() & F.col("_first").isNull()).drop("_first")


def keep_first(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    return flag_repeats(df, key, order, "_repeat").where("not _repeat").drop("_repeat")


def duplicate_groups(files: DataFrame, key: str, path: str = "path") -> DataFrame:
    """(key, kept, n_duplicates): content that several files share; the first by path is kept."""
    return files.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(path).alias("kept"), (F.count("*") - 1).alias("n_duplicates")).where("n_duplicates > 0")
