"""HTML pages: a small tolerant tree, metadata, text blocks and article candidates.

Plain Python over the standard parser, called from Arrow-batched functions; the ranking of candidates is a column
expression in ``operators.web``.
"""

from __future__ import annotations

import html
import json
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import UTC, datetime
from html.parser import HTMLParser
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import DataFrame

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
#: Tags that hold blocks of text, and tags that are left out of it.
BLOCK = {"p", "h1", "h2", "h3", "h4", "blockquote", "li", "div", "figcaption"}
DROP = {"script", "style", "noscript", "svg", "form", "button", "nav", "footer", "header", "aside", "iframe"}
#: Classes that usually hold an article.
ARTICLE_CLASSES = ["article-body", "article-content", "post-content", "entry-content", "story-body", "news-content"]
#: Fixed value: words in a class or id that may mark an article.
IDENTITY = re.compile("article|content|entry|news|post|story", re.I)
#: Words in a candidate's selector and classes that speak for and against it, and how many nodes are looked at.
POSITIVE = ["article", "body", "content", "entry", "news", "post", "story", "text"]
NEGATIVE = [
    "advert", "banner", "breadcrumb", "comment", "cookie", "footer", "header", "menu", "modal", "navbar", "newsletter", "promo", "recommend", "related", "share", "sidebar", "social",
    "subscribe", "tag-list", "toolbar",
]
PLAIN = ["article", '[itemprop="articleBody"]']
NODES, CONTAINERS = 20, 5000
_SPACE = re.compile(r"\s+")


@dataclass
class Node:
    tag: str
    attrs: dict[str, str] = field(default_factory=dict)
    children: list[Node | str] = field(default_factory=list)

    def walk(self) -> Iterator[Node]:
        yield self
        for c in self.children:
            if isinstance(c, Node):
                yield from c.walk()

    def text(self, skip: set[str] = frozenset()) -> str:
        out: list[str] = []

        def go(n: Node) -> None:
            for c in n.children:
                if isinstance(c, str):
                    out.append(c)
                elif c.tag not in skip:
                    go(c)

        go(self)
        return _SPACE.sub(" ", " ".join(out)).strip()

    def identity(self) -> str:
        return f"{self.attrs.get('class', '')} {self.attrs.get('id', '')}"


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("root")
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs})
        if tag in ("p", "li") and self.open[-1].tag == tag:
            self.open.pop()
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.open[-1].children.append(Node(tag, {k: v or "" for k, v in attrs}))

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                break

    def handle_data(self, data):
        self.open[-1].children.append(data)


def parse(page: str) -> Node:
    b = _Builder()
    b.feed(page)
    b.close()
    return b.root


def clean(text: str) -> str:
    """One line of text: entities, composition and white space in one form, none before punctuation."""
    t = unicodedata.normalize("NFC", html.unescape(text)).replace("\xa0", " ")
    return re.sub(r" +([.,:;!?])", r"\1", _SPACE.sub(" ", t)).strip()


def blocks(root: Node) -> list[str]:
    """Text blocks in visual order: inline text is gathered up to the next block boundary; fragments of one character and
    consecutive repeats are left out."""
    out: list[str] = []
    held: list[str] = []

    def flush() -> None:
        t = clean(" ".join(held))
        held.clear()
        if len(t) >= 2 and (not out or out[-1] != t):
            out.append(t)

    def go(n: Node) -> None:
        for c in n.children:
            if isinstance(c, str):
                held.append(c)
            elif c.tag == "br":
                flush()
            elif c.tag not in DROP:
                edge = c.tag in BLOCK or c.tag in ("section", "article", "main", "ul", "ol", "table", "tr")
                if edge:
                    flush()
                go(c)
                if edge:
                    flush()

    go(root)
    flush()
    return out


def leaves(value, path: str = "") -> Iterator[tuple[str, str]]:
    """(path, string) of every string in a JSON value."""
    if isinstance(value, str):
        yield path, value
    elif isinstance(value, dict):
        for k, v in value.items():
            yield from leaves(v, f"{path}.{k}")
    elif isinstance(value, list):
        for v in value:
            yield from leaves(v, path)


def first_json(text: str) -> str | None:
    """The first balanced object in a text."""
    start = text.find("{")
    depth, quoted, escaped = 0, False, False
    for i in range(start, len(text)) if start >= 0 else ():
        c = text[i]
        if quoted:
            quoted, escaped = (escaped or c != '"'), (c == "\\" and not escaped)
        elif c == '"':
            quoted = True
        elif c in "{}":
            depth += 1 if c == "{" else -1
            if not depth:
                return text[start : i + 1]
    return None


def _scripts(root: Node) -> Iterator[tuple[str, object]]:
    for n in root.walk():
        if n.tag != "script":
            continue
        raw = "".join(c for c in n.children if isinstance(c, str))
        kind = "jsonld" if "ld+json" in n.attrs.get("type", "") else "next" if n.attrs.get("id") == "__NEXT_DATA__" else "nuxt" if "nuxt" in (n.attrs.get("id", "") + raw[:200]).lower() else None
        if kind:
            try:
                yield kind, json.loads(raw)
            except ValueError:
                obj = first_json(raw)
                try:
                    yield kind, json.loads(obj) if obj else None
                except ValueError:
                    continue


def _time(value: str | None) -> str | None:
    """An ISO time, or the date at its start, in UTC; None where it is neither."""
    v = (value or "").strip()
    for text in (v.replace("Z", "+00:00"), v[:10]):
        try:
            t = datetime.fromisoformat(text)
        except ValueError:
            continue
        return (t if t.tzinfo else t.replace(tzinfo=UTC)).astimezone(UTC).isoformat(timespec="seconds")
    return None


def url_day(url: str) -> str | None:
    """The date in a path like /2024/5/31/ as midnight UTC."""
    m = re.search(r"/(20\d\d)/(\d{1,2})/(\d{1,2})(?:/|$)", urlsplit(url).path)
    try:
        return datetime(*map(int, m.groups()), tzinfo=UTC).isoformat(timespec="seconds") if m else None
    except ValueError:
        return None


def metadata(root: Node, url: str = "") -> tuple[str | None, str | None, str | None]:
    """(title, published, section) from meta tags, time tags, JSON-LD, the title tag and, last, the date in the url."""
    meta: dict[str, str] = {}
    for n in root.walk():
        if n.tag == "meta":
            meta.setdefault(n.attrs.get("property") or n.attrs.get("name") or n.attrs.get("itemprop") or "", n.attrs.get("content", "").strip())
    head = next((n.text() for n in root.walk() if n.tag == "title"), "")
    title = clean(meta.get("og:title") or meta.get("twitter:title") or head)[:1000] or None
    days = [meta.get("article:published_time"), meta.get("date"), *[n.attrs["datetime"] for n in root.walk() if n.tag == "time" and n.attrs.get("datetime")][:1]]
    days += [v for k, j in _scripts(root) if k == "jsonld" for p, v in leaves(j) if re.search(r"(?i)(datepublished|uploaddate)$", p)]
    day = next((t for t in map(_time, days) if t), None) or url_day(url)
    return title, day, meta.get("article:section") or meta.get("og:section") or None


def is_article(root: Node, url: str = "") -> bool:
    """An article by its type, by its JSON-LD, or by a dated url at least three folders deep."""
    for n in root.walk():
        if n.tag == "meta" and n.attrs.get("property") == "og:type" and n.attrs.get("content", "").lower() == "article":
            return True
    if any(v.lower() in ("article", "newsarticle") for k, j in _scripts(root) if k == "jsonld" for p, v in leaves(j) if p.lower().endswith("@type")):
        return True
    return bool(url_day(url)) and urlsplit(url).path.strip("/").count("/") >= 3


def page_metadata(pages: DataFrame) -> DataFrame:
    """(page_id, title, published, section, article) of pages (page_id, url, html)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for i, u, h in zip(b["page_id"], b["url"], b["html"]):
                if isinstance(h, str):
                    root = parse(h)
                    rows.append((i, *metadata(root, u or ""), is_article(root, u or "")))
            yield pd.DataFrame(rows, columns=["page_id", "title", "published", "section", "article"])

    return pages.select("page_id", "url", "html").mapInPandas(run, "page_id bigint, title string, published string, section string, article boolean")


def _as_text(value: str) -> tuple[str, int]:
    bs = blocks(parse(value)) if "<" in value else [clean(x) for x in value.split("\n") if x.strip()]
    return "\n\n".join(bs), len(bs)


def candidates(page: str) -> list[tuple[str, str | None, str, float, int, float]]:
    """(method, selector, text, score, paragraphs, link density) of a page's possible articles, before the reranking."""
    root = parse(page)
    out = []
    for kind, j in _scripts(root):
        for p, v in leaves(j):
            key = p.rpartition(".")[2].lower()
            if len(v) < 300:
                continue
            if kind == "jsonld" and not (key == "articlebody" or key in ("text", "content")):
                continue
            if kind == "next" and not re.search("body|content|article|text", key):
                continue
            if kind == "nuxt" and not re.search(r"<(p|div|blockquote|h2)\b", v.lower()):
                continue
            text, n = _as_text(v)
            if len(text) >= 250:
                marked = len(re.findall(r"<(?:p|div|blockquote)\b", v.lower()))
                score = {"jsonld": 10_000.0, "next": 5_000.0, "nuxt": (6_000.0 if "post-content" in v.lower() else 2_000.0) + 100 * marked}[kind] + len(text)
                out.append((kind, None, text, score, n, 0.0))
    picked: list[tuple[str, Node]] = []
    # of each plain selector the first NODES count, of marked containers CONTAINERS
    taken: dict[str, int] = {}
    for n in root.walk():
        names = n.attrs.get("class", "").split()
        if n.attrs.get("itemprop") == "articleBody":
            picked.append(('[itemprop="articleBody"]', n))
        elif n.tag == "article":
            picked.append(("article", n))
        elif any(c in names for c in ARTICLE_CLASSES):
            picked.append(("." + next(c for c in ARTICLE_CLASSES if c in names), n))
        elif n.tag in ("div", "section", "main") and IDENTITY.search(n.identity()):
            picked.append((n.tag + "".join("." + c for c in names[:3]), n))
    for selector, n in picked:
        general = selector in PLAIN or selector[1:] in ARTICLE_CLASSES
        group = selector if general else "containers"
        taken[group] = taken.get(group, 0) + 1
        if taken[group] > (NODES if general else CONTAINERS):
            continue
        bs = blocks(n)
        text = "\n\n".join(bs)
        if len(text) < 250:
            continue
        links = sum(len(a.text()) for a in n.walk() if a.tag == "a")
        density = links / max(1, len(n.text(DROP)))
        paragraphs = sum(x.tag in ("p", "blockquote", "li") for x in n.walk())
        known = f"{selector} {n.attrs.get('class', '')}".lower()
        hints = 800 * sum(w in known for w in POSITIVE) - 2500 * sum(w in known for w in NEGATIVE)
        out.append(("dom", selector, text, float(len(text) + paragraphs * 180 + hints - density * 5000), paragraphs, density))
    return out


def page_candidates(pages: DataFrame) -> DataFrame:
    """(page_id, candidate_id, method, selector, text, score, paragraph_count, link_density) of pages (page_id, html). A page
    that can't be parsed or holds nothing has no row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for i, h in zip(b["page_id"], b["html"]):
                if isinstance(h, str):
                    rows.extend((i, f"c{k:03d}", *c) for k, c in enumerate(candidates(h), 1))
            yield pd.DataFrame(rows, columns=["page_id", "candidate_id", "method", "selector", "text", "score", "paragraph_count", "link_density"])

    return pages.select("page_id", "html").mapInPandas(run, "page_id bigint, candidate_id string, method string, selector string, text string, score double, paragraph_count int, link_density double")
