"""The token ledger: an append log whose latest row per path counts, budgets per category, and changes to it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Tokens wanted per category, in millions.
BUDGETS = {"web_news": 240, "gov_legal": 180, "education": 180, "reference": 180, "books": 120, "conversations": 120, "technical": 120, "domain_haf": 60}


def latest(log: DataFrame, key: str = "path", order: tuple[str, ...] = ("processed_at", "book_id")) -> DataFrame:
    """The last row of each key; null times come first. Map-side combined, so a long history of one path is cheap. The first
    mark as duplicate stays through later rows."""
    rest = [c for c in log.columns if c != key and c not in order]
    rank = [F.coalesce(F.col(order[0]), F.lit("0001-01-01").cast("timestamp")).alias("_t"), *[F.col(c) for c in order], *[F.col(c) for c in rest]]
    out = log.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(*rank)).alias("_r"), F.max("dedup_status").alias("_s"))
    return out.select(key, *[F.col(f"_r.{c}") for c in order], *[(F.coalesce("_r.dedup_status", "_s").alias(c) if c == "dedup_status" else F.col(f"_r.{c}")) for c in rest])


def collected(current: DataFrame) -> DataFrame:
    """Tokens by category, exact ones where known, without duplicates."""
    return current.where("dedup_status is null").groupBy("category").agg(F.sum(F.coalesce("exact_tokens", "estimated_tokens")).alias("collected_tokens"))


def percent(c: Column, target: Column) -> Column:
    return F.when(target == 0, 0.0).otherwise(F.least(c / target * 100, F.lit(100.0)))


def progress(current: DataFrame, budgets: dict[str, int] | None = None) -> DataFrame:
    """All budgets with what has been collected, and the total as JAMI."""
    b = {k: v * 1_000_000 for k, v in BUDGETS.items()} if budgets is None else budgets
    targets = current.sparkSession.createDataFrame(list(b.items()), "category string, target_tokens bigint")
    j = targets.join(collected(current), "category", "left").fillna(0, ["collected_tokens"])
    all_ = j.rollup("category").agg(F.sum("target_tokens").alias("target_tokens"), F.sum("collected_tokens").alias("collected_tokens"))
    return all_.withColumn("category", F.coalesce("category", F.lit("JAMI"))).withColumn("progress_pct", percent(F.col("collected_tokens"), F.col("target_tokens")))


def mark_duplicates(current: DataFrame, paths: DataFrame) -> DataFrame:
    """``current`` with the given paths marked."""
    p = paths.select("path").distinct().withColumn("_dup", F.lit(True))
    return current.join(p, "path", "left").withColumn("dedup_status", F.when(F.col("_dup"), "duplicate").otherwise(F.col("dedup_status"))).drop("_dup")


def removed(current: DataFrame, paths: list[str] | None = None, category: str | None = None) -> DataFrame:
    """``current`` without some paths or a category; without either, empty."""
    if paths is not None:
        return current.where(~F.col("path").isin(paths))
    return current.where(F.lit(False)) if category is None else current.where(~F.coalesce(F.col("category") == category, F.lit(False)))


def unprocessed(files: DataFrame, current: DataFrame, force: bool = False) -> DataFrame:
    return files if force else files.join(current.select("path"), "path", "left_anti")


def insert_or_fill(table: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """New keys are added; of known ones, null columns are filled."""
    cols = [c for c in table.columns if c != key]
    n = new.groupBy(key).agg(*[F.max(c).alias(f"_{c}") for c in cols])
    return table.join(n, key, "full").select(key, *[F.coalesce(c, f"_{c}").alias(c) for c in cols])


def retry_minutes(attempts: Column, most: int = 60) -> Column:
    return F.least(F.lit(most), (F.lit(5) * F.pow(F.lit(2.0), attempts - 1)).cast("bigint"))


def expired(files: DataFrame, modified: str, now: Column, days: int) -> DataFrame:
    """Files last changed more than ``days`` before ``now``; what has no time stays."""
    return files.where(F.col(modified) < now - F.expr(f"INTERVAL {int(days)} DAYS"))
