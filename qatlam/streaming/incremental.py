"""Incremental cleaning as a stream: new block files are cleaned as they come, and a paragraph is kept the first time it is
seen. The checkpoint replaces cursors and restart logic; an available-now trigger runs until all files are done."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qatlam.functions.quality import Thresholds, is_uzbek, language_score, quality_reason
from qatlam.functions.text import content_hash, normalized, strip_garbage, to_latin


def cleaned_rows(blocks: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """The rules that need no other row, for batch and stream alike."""
    b = blocks.withColumn("latin", F.explode(F.array(strip_garbage(to_latin(F.coalesce("text", F.lit("")))))))
    reason = F.coalesce(F.when(~is_uzbek(language_score(F.col("latin")), t=t), "til_ozbekcha_emas"), quality_reason(F.col("latin"), t))
    return b.withColumn("drop_reason", reason).withColumn("clean_text", normalized(F.col("latin"))).drop("latin")


def first_paragraphs(stream: DataFrame, event_time: str | None = None, delay: str = "7 days", t: Thresholds = Thresholds()) -> DataFrame:
    """Kept paragraphs, each once. With an event time the state is bounded by the watermark; without it, all hashes stay."""
    kept = cleaned_rows(stream, t).where("drop_reason is null and clean_text <> ''").withColumn("key", content_hash(F.col("clean_text")))
    if event_time is None:
        return kept.dropDuplicates(["key"])
    return kept.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["key"])


def run_available(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, files_per_trigger: int = 1000) -> None:
    """Cleans all files not seen yet from ``source`` into ``target``, exactly once."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(source)
    q = first_paragraphs(stream).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def first_seen(stream: DataFrame, key: str) -> DataFrame:
    """Rows whose key was not seen before, over the whole stream; null keys are left out."""
    return stream.where(F.col(key).isNotNull()).dropDuplicates([key])


def late_counts(stream: DataFrame, time: str, window: str = "1 day", delay: str = "7 days") -> DataFrame:
    """(start, n) rows per window of event time; rows later than ``delay`` behind the newest are left out."""
    return stream.withWatermark(time, delay).groupBy(F.window(time, window).alias("w")).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "n")


def to_table(stream: DataFrame, target: str, checkpoint: str) -> DataFrame:
    """Runs a stream over all that is there now, exactly once per checkpoint, and gives what it has written."""
    q = stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(target)
