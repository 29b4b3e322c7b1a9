"""Candidate ranking, block budgets, the crawl frontier, link graphs and bundles."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qatlam.functions.quality import is_trash
from qatlam.functions.text import clean_lines, stripped
from qatlam.runtime import cut

#: Phrases of legal pages.
LEGAL = ["shaxsiy ma’lumot", "maxfiylik siyosat", "privacy policy", "terms and conditions", "cookie policy", "foydalanish shartlari"]
STRUCTURED = ["jsonld", "nuxt", "next"]


def title_overlap(title: Column, text: Column) -> Column:
    """Share of the title's words of four letters and more within the text's first 1600 characters."""
    pattern = F.lit(r"[\p{L}\p{N}_ʻʼ‘’'-]+")
    t = F.array_distinct(F.filter(F.regexp_extract_all(F.lower(title), pattern, F.lit(0)), lambda w: F.length(w) >= 4))
    o = F.regexp_extract_all(F.lower(F.left(text, F.lit(1600))), pattern, F.lit(0))
    return F.when(F.size(t) > 0, F.size(F.array_intersect(t, o)) / F.size(t)).otherwise(0.0)


def ranked(candidates: DataFrame, pages: DataFrame, top: int = 12) -> DataFrame:
    """(page_id, candidate_id, final_score, rank): scores with the title's overlap and the legal penalty; of equal texts of a
    page the best stays, then the best ``top``. Ties keep the candidates' order."""
    c = candidates.join(pages.select("page_id", "title"), "page_id", "left")
    legal = F.lit(False)
    for phrase in LEGAL:
        legal = legal | F.lower(F.left("text", F.lit(1200))).contains(phrase)
    s = c.select("page_id", "candidate_id", F.sha2("text", 256).alias("_h"),
                 (F.col("score") + F.coalesce(title_overlap(F.col("title"), F.col("text")), F.lit(0.0)) * 14000 - legal.cast("int") * 16000).alias("final_score"))
    order = [F.desc("final_score"), F.col("candidate_id")]
    s = s.withColumn("_r", F.row_number().over(Window.partitionBy("page_id", "_h").orderBy(*order))).where("_r = 1")
    return s.withColumn("rank", F.row_number().over(Window.partitionBy("page_id").orderBy(*order))).where(F.col("rank") <= top).drop("_r", "_h")


def accepted(method: Column, length: Column, article_page: Column) -> Column:
    """Whether a candidate is taken without a saved choice for its site."""
    return (article_page | (length >= 700)) & method.isin(STRUCTURED)


def content_blocks(text: Column) -> Column:
    """Cleaned blocks without trash and without blocks whose letters and digits came before."""
    blocks = F.filter(F.transform(F.split(text, "\n"), lambda b: stripped(clean_lines(b))), lambda b: (b != "") & ~is_trash(b))
    key = lambda b: F.regexp_replace(F.lower(b), r"[^\p{L}\p{N}_]+", "")
    keys = F.transform(blocks, key)
    return F.filter(blocks, lambda b, i: (key(b) != "") & (F.array_position(keys, key(b)) == i + 1))


def within_budget(rows: DataFrame, key: list[str], order: list[str], size: Column, budget: int) -> DataFrame:
    """The first rows of each key up to a total size, always at least one. Keys are documents or pages, whose rows are few."""
    w = Window.partitionBy(*key).orderBy(*order)
    total = F.sum(size).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("_n", F.row_number().over(w)).withColumn("_t", total).where((F.col("_n") == 1) | (F.col("_t") <= budget)).drop("_n", "_t")


def frontier(pages: DataFrame, k: int) -> DataFrame:
    """The ``k`` newest pages not yet fetched."""
    when = F.coalesce("published_at", "sitemap_lastmod", F.lit("1970-01-01"))
    return pages.where("status = 'discovered'").orderBy(when.desc(), F.desc("discovered_at"), "page_id").limit(k)


def recent_median(pages: DataFrame, n: int = 100) -> DataFrame:
    last = pages.where("clean_chars is not null").orderBy(F.desc("updated_at"), "page_id").limit(n)
    return last.where("clean_chars > 0").agg(F.median("clean_chars").alias("median_chars"))


def reachable(links: DataFrame, seeds: DataFrame, max_pages: int | None = None) -> DataFrame:
    """(page, depth): breadth first from the seeds over (source, target) links; each round joins the frontier only."""
    seen = cut(seeds.select("page").distinct().withColumn("depth", F.lit(0)))
    edge, depth = seen, 0
    while True:
        depth += 1
        nxt = edge.join(links, edge["page"] == links["source"]).select(F.col("target").alias("page")).distinct().join(seen.select("page"), "page", "left_anti")
        edge = cut(nxt.withColumn("depth", F.lit(depth)))
        if edge.isEmpty():
            break
        seen = cut(seen.union(edge))
        if max_pages is not None and seen.count() >= max_pages:
            break
    return seen if max_pages is None else seen.orderBy("depth", "page").limit(max_pages)


def bundled(articles: DataFrame, limit: int = 50 * 1024 * 1024) -> DataFrame:
    """(domain, article_id, bundle): articles in crawl order put into bundles that hold at most ``limit`` bytes and end before
    an article of a later month; an article is never split. The order within a domain is sequential, so its rows are
    streamed, never collected."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        domain, bundle, used, month = None, 0, 0, ""
        for b in batches:
            out = []
            for d, i, day, size in zip(b["domain"], b["article_id"], b["day"], b["size"]):
                m = (day or "")[:7]
                if d != domain:
                    domain, bundle, used, month = d, 1, 0, m
                elif m > month or used + size > limit:
                    bundle, used = bundle + 1, 0
                used, month = used + size, m
                out.append((d, i, bundle))
            yield pd.DataFrame(out, columns=["domain", "article_id", "bundle"])

    a = articles.select("domain", "article_id", "day", "size", "seq").repartition("domain").sortWithinPartitions("domain", "seq")
    return a.mapInPandas(run, "domain string, article_id bigint, bundle int")
