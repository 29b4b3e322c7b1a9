"""State of a crawl and of a dataset fetch as tables: pages, sitemaps, adapters, bundles, cursors, settings. Every change
takes the table as it is and gives it as it becomes; callers write it where they keep their state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qatlam.functions.urls import parsed_time, url_date
from qatlam.operators.ordered import numbered

#: Statuses that a restart puts back, and to what.
RESTART = {"processing": "discovered", "writing": "discovered", "ai_processing": "ai_pending", "download_failed": "discovered"}


def add_pages(pages: DataFrame, new: DataFrame) -> DataFrame:
    """``pages`` (url, published_at, sitemap_lastmod, status) with the pages of ``new`` (url, published_at, sitemap_lastmod): an
    unknown url is added as discovered, with the date in its url where it has none; of a known one an empty publication date is
    filled and, where a date came, the sitemap's date replaced. Equal urls of ``new`` are one page."""
    time = F.date_format(parsed_time(F.col("published_at")), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    n = new.where("url is not null").select("url", F.coalesce(time, url_date(F.col("url"))).alias("_p"), F.col("sitemap_lastmod").alias("_s"))
    n = n.groupBy("url").agg(F.max("_p").alias("_p"), F.max("_s").alias("_s"), F.lit(True).alias("_new"))
    j = pages.withColumn("_old", F.lit(True)).join(n, "url", "full")
    changed = F.col("_old").isNotNull() & F.col("_p").isNotNull()
    lastmod = F.when(F.col("_old").isNull(), F.col("_s")).when(changed, F.coalesce("_s", "sitemap_lastmod")).otherwise(F.col("sitemap_lastmod"))
    return j.select("url", F.coalesce("published_at", "_p").alias("published_at"), lastmod.alias("sitemap_lastmod"), F.coalesce("status", F.when(F.col("_old").isNull(), "discovered")).alias("status"))


def recovered(status: Column) -> Column:
    """The status after a restart: what was under way is tried again."""
    out = status
    for a, b in RESTART.items():
        out = F.when(status == a, b).otherwise(out)
    return out


def pending(pages: DataFrame) -> DataFrame:
    return pages.agg(F.count_if(F.col("status") == "discovered").alias("n_pending"))


def ai_pages(pages: DataFrame, domain: str, k: int) -> DataFrame:
    """The newest ``k`` pages of a domain that wait for a decision."""
    return pages.where((F.col("status") == "ai_pending") & F.col("url").contains(domain)).orderBy(F.coalesce("published_at", F.lit("")).desc(), "page_id").limit(k)


def upsert_sitemaps(sitemaps: DataFrame, seen: DataFrame) -> DataFrame:
    """``sitemaps`` (url, depth, source_lastmod, status, cursor) after ``seen`` (url, depth, source_lastmod): new ones are
    pending; a known one whose date changed starts again from its beginning; without a date nothing changes."""
    s = seen.groupBy("url").agg(F.max(F.struct(F.col("source_lastmod").alias("l"), F.col("depth").alias("d"))).alias("_s"))
    j = sitemaps.withColumn("_old", F.lit(True)).join(s, "url", "full")
    again = F.col("_old").isNull() | (F.col("_s.l").isNotNull() & ~F.col("_s.l").eqNullSafe(F.col("source_lastmod")))
    pick = lambda new, old: F.when(again, new).otherwise(F.col(old)).alias(old)
    return j.select("url", pick(F.col("_s.d"), "depth"), pick(F.col("_s.l"), "source_lastmod"), pick(F.lit("pending"), "status"), pick(F.lit(0), "cursor"))


def next_sitemap(sitemaps: DataFrame, k: int = 1) -> DataFrame:
    return sitemaps.where("status = 'pending'").orderBy(F.coalesce("source_lastmod", F.lit("")).desc(), "depth", "url").limit(k)


def upsert_adapters(adapters: DataFrame, new: DataFrame) -> DataFrame:
    """(domain, method, selector, confidence, samples, updated_at): the newest choice of each domain, samples added up."""
    both = adapters.unionByName(new)
    latest = F.max(F.struct("updated_at", "method", "selector", "confidence")).alias("r")
    return both.groupBy("domain").agg(latest, F.sum("samples").alias("samples")).select("domain", "r.method", "r.selector", "r.confidence", "samples", "r.updated_at")


def by_adapter(candidates: DataFrame, adapters: DataFrame) -> DataFrame:
    """Of each page the first candidate (by rank) of the method and, where one is kept, the selector of its domain's adapter.
    ``candidates`` hold (domain, page_id, candidate_id, method, selector, rank)."""
    a = adapters.select("domain", F.col("method").alias("_m"), F.coalesce("selector", F.lit("")).alias("_s"))
    j = candidates.join(a, "domain").where((F.col("method") == F.col("_m")) & ((F.col("_s") == "") | (F.col("selector") == F.col("_s"))))
    first = j.groupBy("page_id").agg(F.min(F.struct("rank", "candidate_id")).alias("r"))
    return first.select("page_id", "r.candidate_id")


def put(settings: DataFrame, new: DataFrame) -> DataFrame:
    """(key, value): ``settings`` with the values of ``new``, whose keys are distinct."""
    return settings.join(new.select("key"), "key", "left_anti").select("key", "value").unionByName(new.select("key", "value"))


def cursors(progress: DataFrame, new: DataFrame) -> DataFrame:
    """(key, last_shard, shard_size): each key's cursor moved to the new last shard. The shard size is pinned by the first run:
    ``conflict`` tells of a run with another size, whose cursor stays where it is."""
    j = progress.toDF("key", "_l", "_s").join(new, "key", "full")
    conflict = F.coalesce((F.col("_s") != F.col("shard_size")), F.lit(False))
    return j.select("key", F.when(conflict, F.col("_l")).otherwise(F.coalesce("last_shard", "_l")).alias("last_shard"), F.coalesce("_s", "shard_size").alias("shard_size"), conflict.alias("conflict"))


def with_ids(items: DataFrame, new: DataFrame, order: list[str], name: str = "dataset_id") -> DataFrame:
    """``new`` with numbers that follow the greatest of ``items``."""
    top = items.agg(F.coalesce(F.max(name), F.lit(0)).alias("_top"))
    return numbered(new, order, "_n").crossJoin(F.broadcast(top)).withColumn(name, F.col("_top") + F.col("_n")).drop("_top", "_n")


def in_flight(items: DataFrame, bundles: DataFrame) -> DataFrame:
    """Items still being written, with their bundle's file."""
    return items.where("status = 'writing'").join(bundles.select("bundle_id", "file"), "bundle_id")


def pages_of_bundles(pages: DataFrame, items: DataFrame, bundle_ids: DataFrame) -> DataFrame:
    """Pages with an item in one of the bundles."""
    return pages.join(items.join(bundle_ids, "bundle_id", "left_semi").select("page_id"), "page_id", "left_semi")


def run_counters(runs: DataFrame) -> DataFrame:
    """Totals of a run over (status, tokens): files done, skipped and failed, and tokens."""
    n = lambda s: F.count_if(F.col("status") == s)
    return runs.agg(n("ok").alias("n_ok"), n("skipped").alias("n_skipped"), n("error").alias("n_errors"), F.coalesce(F.sum(F.when(F.col("status") == "ok", F.col("tokens"))), F.lit(0)).alias("n_tokens"))


def places(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """``rows`` with their ``place`` from 1 in the order within their key, without one task for a key."""
    from qatlam.operators.ordered import running_total

    return running_total(rows, key, order, F.lit(1), "_before").withColumn("place", F.col("_before") + 1).drop("_before")


