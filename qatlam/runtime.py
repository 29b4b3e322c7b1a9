"""Session-level helpers shared by all operators."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; callers select their columns, so the scan stays pruned."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder in which lineage is cut: the cluster's ``spark.checkpoint.dir``, or what the session has set. A local session
    that names none, as in tests, gets a temporary folder; on a cluster a folder of one machine would be lost with it, so there
    one must be named."""
    sc = spark.sparkContext
    named = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = os.path.join(tempfile.gettempdir(), "qatlam-checkpoints")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(named)
    return named


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint of a (narrow) intermediate table. It survives lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager)


def fits(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has at most ``rows`` rows, reading no more than it must."""
    return df.limit(rows + 1).count() <= rows


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Over all shuffle partitions, however few bytes there are: for rows that cost much work each."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def widened(scan: DataFrame) -> DataFrame:
    """A scan, with narrow steps at most, over all shuffle partitions if it has so few splits that cores would idle; a scan of
    many splits stays as it is and is not shuffled."""
    return scan if scan.rdd.getNumPartitions() * 2 >= scan.sparkSession.sparkContext.defaultParallelism else spread(scan)
