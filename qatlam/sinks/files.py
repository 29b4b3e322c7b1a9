"""Where cleaned texts, rejected blocks, reports and articles are written. Spark's committer makes each write whole or not at
all, which replaces journals and repair of half-written files; a run that ended early is repeated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qatlam.functions.names import file_name


def stem(path: Column) -> Column:
    """A file's name without its ending."""
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]+$", "")


def write_texts(documents: DataFrame, folder: str, mode: str = "overwrite") -> None:
    """``documents`` (path, part, kept_text, category) as parquet by category, sorted by path and part within files. One file a
    document would be millions of files; ``export_texts`` writes those of a selection."""
    d = documents.select(stem(F.col("path")).alias("name"), "path", "part", F.col("kept_text").alias("text"), F.coalesce("category", F.lit("uncategorized")).alias("category"))
    d.repartitionByRange("category", "path").sortWithinPartitions("category", "path", "part").write.mode(mode).partitionBy("category").parquet(folder)


def export_texts(documents: DataFrame, folder: str) -> DataFrame:
    """Writes each document as ``folder/category/name.txt`` from the executors, parts in order, and gives (file, n_chars).
    ``folder`` must be shared; a file is written under another name first and then moved, so a repeated task is harmless."""
    import os
    from collections.abc import Iterator
    from uuid import uuid4

    import pandas as pd

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        target, out, name, n = None, None, None, 0
        done: list[tuple[str, int]] = []

        def close() -> None:
            if out is not None:
                out.close()
                os.replace(out.name, target)
                done.append((target, n))

        for b in batches:
            for category, stem_, part, text in zip(b["category"], b["name"], b["part"], b["kept_text"]):
                file = os.path.join(folder, category, f"{stem_}.txt")
                if file != target:
                    close()
                    os.makedirs(os.path.dirname(file), exist_ok=True)
                    target, n = file, 0
                    out = open(f"{file}.{uuid4().hex}", "w", encoding="utf-8")  # noqa: SIM115
                else:
                    out.write("\n\n")
                    n += 2
                out.write(text)
                n += len(text)
            if len(done) > 1000:
                yield pd.DataFrame(done, columns=["file", "n_chars"])
                done.clear()
        close()
        yield pd.DataFrame(done, columns=["file", "n_chars"])

    safe = F.regexp_replace(stem(F.col("path")), r"[^\p{L}\p{N}._-]+", "_")
    d = documents.select(F.coalesce("category", F.lit("uncategorized")).alias("category"), safe.alias("name"), "part", "kept_text")
    return d.repartition("category", "name").sortWithinPartitions("category", "name", "part").mapInPandas(run, "file string, n_chars bigint")


def rejected(blocks: DataFrame) -> DataFrame:
    """(path, page, reason, text) of the dropped blocks of a funnel's rows (path, page, text, drop_reason)."""
    return blocks.where("drop_reason is not null").select("path", "page", F.col("drop_reason").alias("reason"), "text")


def write_rejected(blocks: DataFrame, folder: str, mode: str = "overwrite") -> None:
    """Dropped blocks with their text as JSON lines, by reason."""
    rejected(blocks).write.mode(mode).partitionBy("reason").json(folder)


def write_reports(reports: DataFrame, folder: str, mode: str = "overwrite") -> None:
    """Reports of documents as JSON lines."""
    reports.write.mode(mode).json(folder)


def write_bundles(articles: DataFrame, folder: str, mode: str = "overwrite") -> None:
    """``articles`` (domain, bundle, seq, article_id, text, title, day, url) as pairs of a text and a JSON table per bundle:
    ``text/domain=/bundle=`` and ``table/domain=/bundle=``, each bundle's articles in order in one file."""
    a = articles.repartition("domain", "bundle").sortWithinPartitions("domain", "bundle", "seq")
    a.select("domain", "bundle", F.concat("text", F.lit("\n")).alias("value")).write.mode(mode).partitionBy("domain", "bundle").text(f"{folder}/text")
    table = a.select("domain", "bundle", F.col("article_id").alias("id"), "text", "title", F.left("day", F.lit(10)).alias("date"), F.col("domain").alias("source_website"), F.col("url").alias("source_url"))
    table.write.mode(mode).partitionBy("domain", "bundle").json(f"{folder}/table")
