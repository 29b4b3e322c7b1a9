"""Library catalogue pages and crawl rules of sites."""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import parse_qs, parse_qsl, urlencode, urljoin, urlsplit, urlunsplit
from urllib.robotparser import RobotFileParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qatlam.functions import html as H

#: Keys that only track visitors, and the folder that holds the library.
TRACKING = ["utm_source", "utm_medium", "utm_campaign", "fbclid", "gclid"]
LIBRARY_FOLDER = "/kutubxona"


def heading(page: str) -> str | None:
    """The catalogue category that a page belongs to."""
    for n in H.parse(page).walk():
        if n.tag == "div" and "pd-category" in n.attrs.get("class", "").split():
            for h in n.walk():
                if h.tag == "h3" and (t := h.text()):
                    return t
    return None


def links(page: str, url: str) -> list[tuple[str, str | None, str | None]]:
    """(url, item, slug) of a page's links, each once: downloads with their item, and further catalogue pages of the same host."""
    host, out = urlsplit(url).hostname, {}
    for n in H.parse(page).walk():
        if n.tag != "a" or not n.attrs.get("href"):
            continue
        to = urljoin(url, n.attrs["href"])
        p = urlsplit(to)
        item = re.fullmatch(r"(\d+):([\w-]+)", (parse_qs(p.query).get("download") or [""])[0])
        if item:
            out.setdefault(("item", item.group(1)), (to, item.group(1), item.group(2)))
        elif p.hostname == host and p.path.startswith(LIBRARY_FOLDER):
            query = urlencode([(k, v) for k, v in parse_qsl(p.query, keep_blank_values=True) if k.lower() not in TRACKING])
            clean = urlunsplit((p.scheme, p.netloc, p.path, query, ""))
            out.setdefault(("page", clean), (clean, None, None))
    return list(out.values())


def catalogue_links(pages: DataFrame) -> DataFrame:
    """(source, category, target, item_id, slug) of the links of catalogue pages (url, html); further pages have no item."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(u, heading(h), *x) for u, h in zip(b["url"], b["html"]) if isinstance(h, str) for x in links(h, u)]
            yield pd.DataFrame(rows, columns=["source", "category", "target", "item_id", "slug"])

    return pages.select("url", "html").mapInPandas(run, "source string, category string, target string, item_id string, slug string")


def download_item(url: Column) -> tuple[Column, Column]:
    """(item, slug) of a download url, null for others."""
    value = F.regexp_extract(url, r"[?&]download=([0-9]+(?::|%3A|%3a)[\p{L}\p{N}_-]+)(?:&|#|$)", 1)
    part = lambda i: F.when(value != "", F.regexp_extract(value, r"^([0-9]+)(?::|%3A|%3a)(.+)$", i))
    return part(1), part(2)


def allowed(urls: DataFrame, robots: DataFrame, agent: str = "*") -> DataFrame:
    """``urls`` (host, url) with ``allowed`` by their host's rules in ``robots`` (host, rules); a host without rules allows all.
    Rules are joined to urls, so only those of a batch's hosts are parsed, each once."""
    joined = urls.join(robots.select("host", "rules"), "host", "left")

    @F.pandas_udf("boolean")
    def ok(url: pd.Series, rules: pd.Series) -> pd.Series:
        parsed: dict[str, RobotFileParser] = {}
        out = []
        for u, r in zip(url, rules):
            if not isinstance(r, str):
                out.append(True)
                continue
            if r not in parsed:
                parsed[r] = RobotFileParser()
                parsed[r].parse(r.splitlines())
            out.append(parsed[r].can_fetch(agent, u))
        return pd.Series(out)

    return joined.withColumn("allowed", ok("url", "rules")).drop("rules")


def sitemaps_of(robots: DataFrame) -> DataFrame:
    """(host, sitemap) named in the rules of each host, else the usual place."""
    named = F.transform(F.regexp_extract_all("rules", F.lit(r"(?im)^\s*sitemap\s*:\s*(\S+)"), F.lit(1)), lambda x: x)
    usual = F.array(F.concat(F.lit("https://"), F.col("host"), F.lit("/sitemap.xml")))
    return robots.select("host", F.explode(F.when(F.size(F.coalesce(named, F.array().cast("array<string>"))) > 0, named).otherwise(usual)).alias("sitemap"))
