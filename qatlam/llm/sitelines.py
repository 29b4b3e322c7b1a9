"""Lines repeated over the pages of one site (problem 2).

Nodes are line keys of a site with the number of distinct pages on which they stand, edges are pairs of consecutive lines
with theirs. Nodes and edges of high support stay; their connected components are the site's boilerplate blocks, whose
occurrences are removed. Texts are read once: only hashes of lines are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qatlam.runtime import cut

SUPPORT = 5
#: Salt of the joins of occurrences with kept lines: a line of the largest site is spread over so many tasks.
SALT = 8


def line_key(line: Column) -> Column:
    """The letters of a line in order and lower case; empty for a line without letters."""
    return F.regexp_replace(F.lower(line), r"[^\p{L}]+|[ʻʼ]+", "")


def site(url: Column) -> Column:
    """Host in lower case without ``www.``; null where the url has none."""
    host = F.lower(F.regexp_extract(url, r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/:?#\s]+)", 1))
    return F.nullif(F.regexp_replace(host, r"^www\.|\.$", ""), F.lit(""))


def page_of(url: Column) -> Column:
    """What identifies a page within its site: the path without query, fragment and final slash."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(url, r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#\s]+", ""), r"[?#].*$", ""), r"/+\s*$", "")


def page_keys(pages: DataFrame) -> DataFrame:
    """(page_id, site, page) as 64-bit hashes; pages without a host are left out."""
    p = pages.where(site(F.col("url")).isNotNull())
    return p.select("page_id", F.xxhash64(site(F.col("url"))).alias("site"), F.xxhash64(page_of(F.col("url"))).alias("page"))


def occurrences(candidates: DataFrame, pages: DataFrame) -> DataFrame:
    """(page_id, candidate_id, line_no, key, prev, site, page) of all lines with letters; ``prev`` is the key of the line
    with letters before it, null at the start."""
    lines = candidates.where(F.col("text").isNotNull()).select("page_id", "candidate_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    keyed = lines.withColumn("_k", line_key(F.col("line"))).where("_k <> ''").select("page_id", "candidate_id", F.col("line_no").cast("bigint").alias("line_no"), F.xxhash64("_k").alias("key"))
    return keyed.join(page_keys(pages), "page_id")


def nodes(occ: DataFrame, support: int = SUPPORT) -> DataFrame:
    """(site, key, pages) of lines on at least ``support`` distinct pages. Two map-side combined aggregations: first on the
    page, so that no hot line meets in one task before it has shrunk to one row a page."""
    once = occ.groupBy("site", "key", "page").agg(F.lit(1).alias("one"))
    return once.groupBy("site", "key").agg(F.count("*").alias("pages")).where(F.col("pages") >= support)


def kept_occurrences(occ: DataFrame, kept: DataFrame) -> DataFrame:
    """Occurrences of kept lines. Both sides are salted: a third of all rows may be one site's."""
    salted = kept.withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(SALT)])))
    salt = F.pmod(F.xxhash64("page_id", "candidate_id", "line_no"), F.lit(SALT)).cast("int")
    return occ.withColumn("_salt", salt).join(salted, ["site", "key", "_salt"]).drop("_salt")


def edges(found: DataFrame, support: int = SUPPORT) -> DataFrame:
    """(site, a, b, pages): kept lines that follow each other on at least ``support`` pages. ``found`` are the occurrences
    of kept lines; the window runs within one candidate."""
    w = Window.partitionBy("page_id", "candidate_id").orderBy("line_no")
    pairs = found.withColumn("b", F.lead("key").over(w)).withColumn("gap", F.lead("line_no").over(w) - F.col("line_no"))
    pairs = pairs.where((F.col("gap") <= 2) & (F.col("b") != F.col("key"))).select("site", "page", F.least("key", "b").alias("a"), F.greatest("key", "b").alias("b"))
    return pairs.groupBy("site", "a", "b", "page").agg(F.lit(1).alias("one")).groupBy("site", "a", "b").agg(F.count("*").alias("pages")).where(F.col("pages") >= support)


def components(kept: DataFrame, links: DataFrame) -> DataFrame:
    """``kept`` with ``block``, the least key of the line's connected component. Labels are replaced by the least label of
    the neighbours and by their own label's label until none changes; the node table is cut to a file in each round."""
    both = links.select("site", F.col("a").alias("key"), F.col("b").alias("other")).unionByName(links.select("site", F.col("b").alias("key"), F.col("a").alias("other")))
    both = cut(both)
    labels = cut(kept.select("site", "key", F.col("key").alias("block")))
    while True:
        near = both.join(labels.select("site", F.col("key").alias("other"), "block"), ["site", "other"]).groupBy("site", "key").agg(F.min("block").alias("near"))
        step = labels.join(near, ["site", "key"], "left").select("site", "key", F.col("block").alias("old"), F.least("block", "near").alias("block"))
        jump = step.select("site", F.col("key").alias("block"), F.col("block").alias("far"))
        nxt = cut(step.join(jump, ["site", "block"], "left").select("site", "key", "old", F.least("block", "far").alias("block")))
        changed = nxt.where("old <> block").limit(1).count()
        labels = nxt.drop("old")
        if not changed:
            return kept.join(labels, ["site", "key"])


def repeated_lines(candidates: DataFrame, pages: DataFrame, support: int = SUPPORT) -> DataFrame:
    """Occurrences (page_id, candidate_id, line_no, key, site, page) of the lines on at least ``support`` pages of their site: the
    graph's nodes. Candidates whose page is unknown or has no host, null texts and lines without letters have none; equal
    candidates count once per page; empty tables give empty results."""
    occ = occurrences(candidates, pages)
    return kept_occurrences(occ, nodes(occ, support).drop("pages"))


def blocks(found: DataFrame, support: int = SUPPORT) -> DataFrame:
    """(site, key, block): the site's boilerplate blocks, which are the connected components of kept lines. ``found`` are the
    occurrences of the kept lines; a line without a neighbour of high support is a block of its own."""
    return components(found.select("site", "key").distinct(), edges(found, support))


def boilerplate(candidates: DataFrame, pages: DataFrame, support: int = SUPPORT) -> tuple[DataFrame, DataFrame]:
    """The blocks and the occurrences of their lines (page_id, candidate_id, line_no, site, key, block)."""
    found = cut(repeated_lines(candidates, pages, support))
    labels = cut(blocks(found, support))
    salted = labels.withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(SALT)])))
    salt = F.pmod(F.xxhash64("page_id", "candidate_id", "line_no"), F.lit(SALT)).cast("int")
    return labels, found.withColumn("_salt", salt).join(salted, ["site", "key", "_salt"]).drop("_salt")


def block_report(occurrences: DataFrame) -> DataFrame:
    """(site, block, n_lines, n_pages, n_occurrences) of (site, key, block, page, ...)."""
    # first on the line and page, so that a block all over a large site has shrunk before its pages are counted
    once = occurrences.groupBy("site", "block", "key", "page").agg(F.count("*").alias("n"))
    lines = once.groupBy("site", "block", "key").agg(F.sum("n").alias("n")).groupBy("site", "block").agg(F.count("*").alias("n_lines"), F.sum("n").alias("n_occurrences"))
    pages = once.select("site", "block", "page").distinct().groupBy("site", "block").agg(F.count("*").alias("n_pages"))
    return lines.join(pages, ["site", "block"]).select("site", "block", "n_lines", "n_pages", "n_occurrences")


def without_lines(candidates: DataFrame, found: DataFrame) -> DataFrame:
    """``candidates`` with ``clean_text``: the text without the lines found. A text of which nothing is left is ''."""
    gone = found.groupBy("page_id", "candidate_id").agg(F.collect_set(F.col("line_no").cast("int")).alias("_gone"))
    text = F.array_join(
        F.filter(F.split("text", "\n"), lambda x, i: F.col("_gone").isNull() | ~F.array_contains("_gone", i)), "\n"
    )
    return candidates.join(gone, ["page_id", "candidate_id"], "left").withColumn("clean_text", text).drop("_gone")
