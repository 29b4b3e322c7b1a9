"""Row numbers and running totals over an order without one task for all rows.

Rows are range-partitioned by the order; only one number per partition and key is accumulated centrally.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qatlam.runtime import cut


def _ranged(df: DataFrame, order: list[str]) -> DataFrame:
    return cut(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()))


def numbered(df: DataFrame, order: list[str], name: str = "row_no") -> DataFrame:
    """``df`` with a number from 1 in the given order, which should be unique. An empty table stays empty."""
    r = _ranged(df, order)
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = r.groupBy("_part").agg(F.count("*").alias("_n")).withColumn("_base", F.coalesce(F.sum("_n").over(w), F.lit(0))).drop("_n")
    inner = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return r.withColumn("_r", inner).join(F.broadcast(base), "_part").withColumn(name, F.col("_base") + F.col("_r")).drop("_part", "_r", "_base")


def running_total(df: DataFrame, key: list[str], order: list[str], value: Column, name: str = "before") -> DataFrame:
    """``df`` with the sum of ``value`` over the earlier rows of the same key (0 for the first)."""
    r = _ranged(df.withColumn("_v", F.coalesce(value, F.lit(0))), [*key, *order])
    w = Window.partitionBy(*key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = r.groupBy(*key, "_part").agg(F.sum("_v").alias("_s")).withColumn("_base", F.coalesce(F.sum("_s").over(w), F.lit(0))).drop("_s")
    inner = F.coalesce(F.sum("_v").over(Window.partitionBy(*key, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return r.withColumn("_i", inner).join(base, [*key, "_part"]).withColumn(name, F.col("_base") + F.col("_i")).drop("_part", "_i", "_base", "_v")


def shards(df: DataFrame, order: list[str], size: int = 1000, skip: int = 0, limit: int | None = None) -> DataFrame:
    """Rows ``skip`` onwards, at most ``limit``, with a shard number from 1; the last shard may be short."""
    n = numbered(df, order).where(F.col("row_no") > skip)
    if limit is not None:
        n = n.where(F.col("row_no") <= skip + limit)
    return n.withColumn("shard", F.floor((F.col("row_no") - skip - 1) / size) + 1).drop("row_no")


def until_budget(df: DataFrame, key: list[str], order: list[str], tokens: Column, target: Column) -> DataFrame:
    """Rows in order while the total before them is under the target: the one that crosses it is kept."""
    return running_total(df.withColumn("_target", target), key, order, tokens).where(F.col("before") < F.col("_target")).drop("_target")
