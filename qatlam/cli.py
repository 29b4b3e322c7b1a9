"""Command line over the plans: ``python -m qatlam.cli COMMAND --help``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from qatlam.functions.names import folder_category
from qatlam.functions.text import content_hash
from qatlam.operators import dedup, ledger
from qatlam.plans import clean
from qatlam.sinks import files as sinks
from qatlam.sources import readers


def _blocks(spark: SparkSession, folder: str):
    """Blocks of all files below a folder, with paths relative to it and ids by path and index."""
    b = readers.file_blocks(readers.files(spark, folder)).where("error is null")
    path = F.regexp_replace("path", r"^.*?" + folder.rstrip("/").replace(".", r"\.") + "/", "")
    b = b.withColumn("path", path)
    return b.select(F.xxhash64("path", "block_idx").alias("block_id"), "path", "block_idx", "page", "text", "format")


def run(spark: SparkSession, source: str, target: str) -> None:
    """Reads, cleans and writes: texts, rejected blocks and reports, and the ledger's rows."""
    from qatlam.runtime import cut

    blocks = cut(_blocks(spark, source))
    funnel = cut(clean.cleaned(blocks))
    category = folder_category(F.col("path"))
    texts = clean.documents(funnel).withColumn("category", category)
    sinks.write_texts(texts, f"{target}/texts")
    sinks.write_rejected(funnel.join(blocks.select("block_id", "text"), "block_id"), f"{target}/rejected")
    reports = clean.reports(funnel).withColumn("category", category)
    formats = blocks.groupBy("path").agg(F.first("format").alias("format"))
    reports = cut(reports.join(formats, "path").withColumn("exact_tokens", F.lit(None).cast("bigint")))
    sinks.write_reports(reports, f"{target}/reports")
    log = reports.select("path", "category", "format", "char_count", "estimated_tokens", "exact_tokens", "total_blocks", "kept_blocks", "dropped_pct", F.current_timestamp().alias("processed_at"), F.lit(None).cast("string").alias("dedup_status"))
    log.withColumn("book_id", F.xxhash64("path", "processed_at")).write.mode("append").parquet(f"{target}/ledger")


def stats(spark: SparkSession, target: str) -> None:
    """Progress of all budgets by the ledger."""
    current = ledger.latest(spark.read.parquet(f"{target}/ledger"))
    ledger.progress(current).orderBy("category").show(100, truncate=False)


def finalize(spark: SparkSession, target: str) -> None:
    """Marks files of equal text in the ledger and writes the duplicates' groups."""
    from qatlam.runtime import cut

    texts = spark.read.parquet(f"{target}/texts")
    # a document's key is that of its parts in order
    parts = texts.select("path", "part", content_hash(F.col("text")).alias("h"))
    keyed = parts.groupBy("path").agg(F.sha1(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "h"))), lambda x: x["h"]), " ")).alias("hash"))
    keyed = cut(keyed)
    dedup.duplicate_groups(keyed, "hash").write.mode("overwrite").json(f"{target}/duplicates")
    again = dedup.flag_repeats(keyed, "hash", ["path"]).where("is_repeat")
    log = cut(spark.read.parquet(f"{target}/ledger"))
    ledger.mark_duplicates(ledger.latest(log), again).write.mode("overwrite").parquet(f"{target}/ledger-final")


def cleanup(spark: SparkSession, folder: str, days: int) -> None:
    """Lists files older than so many days."""
    ledger.expired(readers.files(spark, folder), "modificationTime", F.current_timestamp(), days).select("path", "length").orderBy("path").show(1000, truncate=False)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="qatlam")
    c = p.add_subparsers(dest="command", required=True)
    for name, args in {"run": ["source", "target"], "stats": ["target"], "finalize": ["target"], "cleanup": ["folder"]}.items():
        q = c.add_parser(name, help=globals()[name].__doc__)
        for a in args:
            q.add_argument(a)
        if name == "cleanup":
            q.add_argument("--days", type=int, default=30)
    a = vars(p.parse_args(argv))
    globals()[a.pop("command")](SparkSession.builder.appName("qatlam").getOrCreate(), **a)


if __name__ == "__main__":
    main()
