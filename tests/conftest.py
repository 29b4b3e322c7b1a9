import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def values(spark):
    """Values of column builders over one column of strings."""

    def run(build, texts, name="x"):
        from pyspark.sql import functions as F

        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, {name} string")
        return [r["v"] for r in df.select("i", build(F.col(name)).alias("v")).orderBy("i").collect()]

    return run
