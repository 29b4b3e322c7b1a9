"""Main content of web pages by page differencing (problem 3).

Pages are range-partitioned and sorted by site and URL path, so that the nearest URLs of a host meet in one streaming
pass without grouping a site in one task. Each text is aligned with every distinct text of the page before and of the page
after by the longest common subsequence of its lines' letters, also where the two pages lie in adjoining partitions; shared
lines are page furniture. What the differences show of all pages is then counted:
lines and line openings that neighbours share, and labels that head a list of links. A last pass over each text's line
features (no text any more) marks the furniture that has no twin on a neighbour: lines between furniture and outside of
the run of paragraphs, links under a label, bylines.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qatlam.llm.sitelines import page_of, site
from qatlam.runtime import cut, fits

#: Texts at the borders of partitions, and keys of known furniture (some 20 bytes each), up to which they are broadcast.
SHIP_TEXTS, SHIP_KEYS = 20_000, 500_000

LETTERS = re.compile(r"[^\W\d_]+")
_SIGNS = str.maketrans("", "", "ʻʼ")
_ENDS = re.compile(r"[.!?…][»”\"'’)\]]*\s*$")
_BULLET = re.compile(r"^\s*(?:[•▪●◦*]|[-–—]|\d{1,3}[.)])\s+")
_USER = re.compile(r"^\W*[^\W\d_]+\d+\b[^:.!?]{0,15}:\s")
_LABEL = re.compile(r"[:→»]\s*$")

#: Bits of a line's feature mask.
ENDS, BULLET, HEADLINE, BYLINE, USER, LABEL, TITLE, MENU, PROSE = (1 << i for i in range(9))


def key_of(line: str) -> str:
    return "".join(LETTERS.findall(line.lower().translate(_SIGNS)))


def features(line: str) -> int:
    """What a line looks like on its own, as bits."""
    words = LETTERS.findall(line)
    n = len(line.split())
    m = 0
    if _ENDS.search(line):
        m |= ENDS
    if _BULLET.match(line):
        m |= BULLET
    if _USER.match(line):
        m |= USER
    if _LABEL.search(line):
        m |= LABEL
    if re.search(r"\S\s*[|·•/>]\s*\S.*[|·•/>]\s*\S", line):
        m |= MENU
    tokens = [t.strip("«»“”\"'’‘.,!?…:;()★—–-") for t in line.split()]
    caps = [t[:1].isupper() for t in tokens if t]
    pair = any(a and b for a, b in zip(caps, caps[1:]))
    if pair and len(words) >= 2 and n <= (5 if m & ENDS else 7) and line.lstrip()[:1] not in "«“„\"":
        m |= BYLINE
    if (6 if any(c.isdigit() for c in line) else 3) <= n <= 12 and not (m & (ENDS | MENU | LABEL)) and sum(caps) <= 2 and not pair:
        m |= HEADLINE
    if n >= 4 and m & ENDS:
        m |= PROSE
    return m


def _opening(line: str) -> str:
    head, colon, rest = line.partition(":")
    if colon and len(head) <= 32 and len(head.split()) <= 3 and rest.strip() and not any(c.isdigit() for c in head):
        return key_of(head)
    return ""


def _hash(s: str) -> int:
    return xxhash.xxh64_intdigest(s) - (1 << 63)


def shared(a: list[int], b: list[int]) -> set[int]:
    """Positions of ``a`` in a longest common subsequence with ``b``; zeros match nothing."""
    common = set(a) & set(b)
    common.discard(0)
    if not common:
        return set()
    at = [i for i, x in enumerate(a) if x in common]
    x, y = [a[i] for i in at], [v for v in b if v in common]
    if x == y:
        return set(at)
    # a row of the table is a number whose bit j is 0 where the length grows at y[j]; 10,000 lines by 10,000 take 12 MB
    at_bit: dict[int, int] = {}
    for j, w in enumerate(y):
        at_bit[w] = at_bit.get(w, 0) | 1 << j
    every = (1 << len(y)) - 1
    row, rows = every, []
    for v in x:
        hit = row & at_bit.get(v, 0)
        row = ((row + hit) | (row - hit)) & every
        rows.append(row)
    i, j, out = len(x), len(y), set()
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
        elif i > 1 and not rows[i - 2] >> (j - 1) & 1:
            i -= 1
        else:
            out.add(at[i - 1])
            i, j = i - 1, j - 1
    return out


_OUT = """text_id bigint, page_id bigint, candidate_id string, site bigint, page bigint, border int,
keys array<bigint>, openings array<bigint>, masks array<int>, words array<int>, shared array<boolean>"""


def _line(line: str, known: dict[str, tuple]) -> tuple[str, int, int, int, int]:
    """(letters, hash of them, hash of the opening, features, words) of a line. Most lines recur in the other texts of the
    page or on the pages beside it, so they are kept for a while."""
    x = known.get(line)
    if x is None:
        if len(known) > 50_000:
            known.clear()
        k, o = key_of(line), _opening(line)
        x = known[line] = (k, _hash(k) if k else 0, _hash("opening " + o) if o else 0, features(line), len(line.split()))
    return x


class _Text:
    def __init__(self, row, known: dict[str, tuple]):
        self.row = row
        self.lines = [_line(x, known) for x in row.text.split("\n")]
        self.keys = [x[1] for x in self.lines]
        self.hits: set[int] = set()

    def columns(self, ident: int, border: int) -> tuple:
        r, title = self.row, key_of(self.row.title) if isinstance(self.row.title, str) else ""
        masks = [x[3] | TITLE if title and x[0] == title else x[3] for x in self.lines]
        shared_ = [i in self.hits for i in range(len(self.lines))]
        return ident, r.page_id, r.candidate_id, r.site, r.page, border, self.keys, [x[2] for x in self.lines], masks, [x[4] for x in self.lines], shared_


def _meet(left: list[tuple[list[int], set[int]]], right: list[tuple[list[int], set[int]]]) -> None:
    """Adds to the hits of all (keys, hits) of two pages the lines that each shares with any of the other page. Equal lists
    of keys are aligned once."""
    lists = [sorted({tuple(k) for k, _ in x}, key=lambda k: (-len(k), k)) for x in (left, right)]
    for here, mine, others in ((left, *lists), (right, *lists[::-1])):
        of: dict[tuple, set[int]] = {}
        for a in mine:
            hits = of[a] = set()
            for b in others:
                common = set(b)
                # nothing to add where all common lines are hits already
                if any(k in common and k and i not in hits for i, k in enumerate(a)):
                    hits |= shared(a, b)
        for k, hits in here:
            hits |= of[tuple(k)]


def _difference(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by site and page. The texts of a page meet those of the page before and of the page after; a page is
    held back until the next one is read. ``border`` is 0, but for the partition's first (1) and last page (2) four times the
    partition's number and the sum of the two."""
    before: list[_Text] = []
    now: list[_Text] = []
    where: tuple | None = None
    known: dict[str, tuple] = {}
    out: list[tuple] = []
    first, part, number = True, TaskContext.get().partitionId(), 0
    names = [c.split()[0] for c in _OUT.replace("\n", " ").split(", ")]

    def leave(texts: list[_Text], last: bool) -> None:
        nonlocal first, number
        if texts:
            side = first + 2 * last
            for x in texts:
                out.append(x.columns(part << 40 | number, 4 * part + side if side else 0))
                number += 1
            first = False

    def turn() -> None:
        if before and before[0].row.site == now[0].row.site:
            _meet([(x.keys, x.hits) for x in before], [(x.keys, x.hits) for x in now])

    for b in batches:
        for row in b.itertuples(index=False):
            here = (row.site, row.page)
            if where is not None and here != where:
                turn()
                leave(before, False)
                before, now = now, []
            where = here
            now.append(_Text(row, known))
        if len(out) > 2_000:
            yield pd.DataFrame(out, columns=names)
            out.clear()
    if now:
        turn()
    leave(before, False)
    leave(now, True)
    yield pd.DataFrame(out, columns=names)


def _border(rows: pd.DataFrame) -> pd.DataFrame:
    """Of the texts of one site's pages at the ends of partitions the lines shared with the page over the border."""
    pages = []
    for (part, first, _), x in rows.assign(part=rows["border"] // 4, first=rows["border"] & 1).groupby(["part", "first", "page"], sort=False):
        pages.append((part, -first, [(i, (k.tolist(), set())) for i, k in zip(x["text_id"], x["keys"])]))
    pages.sort(key=lambda x: x[:2])
    for (p, _, left), (q, _, right) in zip(pages, pages[1:]):
        if p != q:
            _meet([t for _, t in left], [t for _, t in right])
    found = [(i, sorted(hits)) for _, _, texts in pages for i, (_, hits) in texts if hits]
    return pd.DataFrame(found, columns=["text_id", "over"])


def with_borders(texts: DataFrame) -> DataFrame:
    """The texts with their lines shared also where the neighbouring page is in the adjoining partition."""
    over = texts.where("border > 0").select("site", "page", "border", "text_id", "keys").groupBy("site").applyInPandas(_border, "text_id bigint, over array<int>")
    over = cut(over.groupBy("text_id").agg(F.flatten(F.collect_list("over")).alias("over")))
    joined = texts.join(F.broadcast(over) if fits(over, SHIP_TEXTS) else over, "text_id", "left")
    both = F.transform("shared", lambda s, i: s | F.coalesce(F.array_contains("over", i), F.lit(False)))
    return joined.withColumn("shared", F.when(F.col("over").isNull(), F.col("shared")).otherwise(both)).drop("over", "border")


def differenced(candidates: DataFrame, pages: DataFrame) -> DataFrame:
    """One row per candidate: of each line the hash of its letters (0: none), of its opening, its features, words and whether a
    neighbouring page shares it, as arrays. Candidates without a known page stand alone."""
    p = pages.select("page_id", F.xxhash64(site(F.col("url"))).alias("site"), page_of(F.col("url")).alias("path"), "title").dropDuplicates(["page_id"])
    c = candidates.where(F.col("text").isNotNull()).select("page_id", "candidate_id", "text").join(p, "page_id", "left")
    c = c.withColumn("site", F.coalesce("site", F.xxhash64("page_id"))).withColumn("path", F.coalesce("path", F.lit("")))
    c = c.repartitionByRange("site", "path").sortWithinPartitions("site", "path", "page_id", "candidate_id")
    return c.select("page_id", "candidate_id", "site", F.xxhash64("path").alias("page"), "title", "text").mapInPandas(_difference, _OUT)


def furniture_counts(texts: DataFrame) -> DataFrame:
    """What all differences show of each line key and opening: on how many pages it stands and is shared, on how many
    sites, how often a headline follows, how far down it stands. Lines are combined before they are shuffled."""
    heads = F.transform("masks", lambda m, i: (F.coalesce(F.get("masks", i + 1), F.lit(0)).bitwiseAND(HEADLINE) > 0).cast("int"))
    n = texts.select("site", "page", F.size("keys").alias("total"), F.posexplode(F.arrays_zip("keys", "openings", "words", "shared", heads.alias("heads"))).alias("line_no", "x"))
    n = n.select("site", "page", "x.shared", "x.heads", "x.words", F.col("x.keys").alias("key"), F.col("x.openings").alias("opening"), (F.col("line_no") / F.col("total")).alias("depth"))
    keyed = n.where("key <> 0").drop("opening")
    opened = n.where("opening <> 0 and words <= 12").drop("key").withColumnRenamed("opening", "key")
    page = keyed.unionByName(opened).groupBy("key", "site", "page").agg(F.max(F.col("shared").cast("int")).alias("shared"), F.avg("heads").alias("heads"), F.max("words").alias("words"), F.avg("depth").alias("depth"))
    by_site = page.groupBy("key", "site").agg(F.count("*").alias("pages"), F.sum("shared").alias("shared"), F.sum("heads").alias("heads"), F.max("words").alias("words"), F.sum("depth").alias("depth"))
    k = by_site.groupBy("key").agg(F.sum("pages").alias("pages"), F.sum("shared").alias("shared_pages"), F.count("*").alias("sites"), F.sum("heads").alias("heads"), F.max("words").alias("most_words"), F.sum("depth").alias("depth"))
    return k.where((F.col("pages") >= 2)).select("key", "pages", "shared_pages", "sites", (F.col("heads") / F.col("pages")).alias("heads"), (F.col("depth") / F.col("pages")).alias("depth"), "most_words")


def furniture_of(mask: list[int], words: list[int], twin: list[bool], known: list[bool], label: list[bool], opening: list[bool], bare: list[bool]) -> list[int]:
    """Numbers of the furniture lines of one text. ``twin``: shared with a neighbour; ``known``: furniture on other pages;
    ``label``: heads lists of links elsewhere; ``opening``: begins as furniture of other pages does; ``bare``: has no letters, as dates and counters."""
    n = len(mask)
    blank = [w == 0 for w in words]
    lines = [i for i in range(n) if not blank[i]]
    title = next((i for i in lines if mask[i] & TITLE), None)
    sure = {i for i in lines if i != title and (twin[i] or known[i] or opening[i] or mask[i] & (USER | MENU) or bare[i])}
    body = [i for i in lines if i not in sure and mask[i] & PROSE and (words[i] >= 7 or not mask[i] & BYLINE)]
    if not body:
        return [i for i in lines if i != title]
    prose, first, last = set(body), body[0], body[-1]
    head = title if title is not None and title < first else None
    if head is None:
        # the headline: the first line before the paragraphs that looks like one and is not known as furniture
        head = next((i for i in lines if i < first and mask[i] & HEADLINE and i not in sure and words[i] >= 4), None)
        if head is None:
            head = next((i for i in lines if i < first and mask[i] & HEADLINE and not twin[i] and not label[i] and words[i] >= 4), None)
    sure.discard(head)
    out = set(sure)
    start = head if head is not None else first
    under = False
    for i in lines:
        if i == head or i == title:
            under = False
            continue
        if i < start:
            out.add(i)
            continue
        if i in sure:
            under = label[i]
            continue
        if i > last:
            touches = i - 1 == last or (i - 1 not in out and i - 1 > last) or (blank[i - 1] and i - 2 >= 0 and i - 2 not in out)
            if mask[i] & BULLET and touches and not under:
                continue
            out.add(i)
        elif mask[i] & PROSE and i in prose:
            under = False
        elif mask[i] & BYLINE and not mask[i] & BULLET and words[i] <= 7:
            out.add(i)
        elif under and mask[i] & HEADLINE and not mask[i] & BULLET:
            out.add(i)
        elif mask[i] & LABEL and words[i] <= 4:
            out.add(i)
        else:
            under = False
    return sorted(out)


def page_furniture(candidates: DataFrame, pages: DataFrame) -> DataFrame:
    """(page_id, candidate_id, line_no) of all furniture lines. Blank lines are none; a text without any paragraph is
    furniture but for the page's title; null texts and empty tables give nothing; equal candidates of a page are each
    treated in full."""
    texts = with_borders(cut(differenced(candidates, pages)))
    counts = furniture_counts(texts)
    known = cut(counts.where("(shared_pages >= 2 and (most_words <= 25 or shared_pages >= 4)) or pages >= 5").select(
        "key", ((F.col("heads") >= 0.6) & (F.col("pages") >= 4)).alias("label"), (F.col("sites") >= 2).alias("wide")))
    few = fits(known, SHIP_KEYS)
    # only lines that are known, or begin as known ones do, go back to their texts; lines without letters or opening match nothing
    found = None
    for column, keys in (("keys", known.select("key", "label")), ("openings", known.where("wide").select("key", F.lit(None).cast("boolean").alias("label")))):
        at = texts.select("text_id", F.posexplode(column).alias("line_no", "key")).where("key <> 0")
        hit = at.join(F.broadcast(keys) if few else keys, "key").select("text_id", F.struct("line_no", "label").alias("hit"))
        found = hit if found is None else found.unionByName(hit)
    found = found.groupBy("text_id").agg(F.collect_list("hit").alias("hits"))
    joined = texts.join(found, "text_id", "left").select("page_id", "candidate_id", "masks", "words", "shared", F.transform("keys", lambda k: k == 0).alias("bare"), "hits")

    @F.pandas_udf("array<bigint>")
    def gone(masks: pd.Series, words: pd.Series, shared_: pd.Series, bare: pd.Series, hits: pd.Series) -> pd.Series:
        out = []
        for m, w, s, e, h in zip(masks, words, shared_, bare, hits):
            known_, label, opens = ([False] * len(m) for _ in range(3))
            for x in h if h is not None else ():
                if x["label"] is None:
                    opens[x["line_no"]] = True
                else:
                    known_[x["line_no"]], label[x["line_no"]] = True, bool(x["label"])
            out.append(furniture_of(m.tolist(), w.tolist(), s.tolist(), known_, label, opens, e.tolist()))
        return pd.Series(out)

    return joined.select("page_id", "candidate_id", F.explode(gone("masks", "words", "shared", "bare", "hits")).alias("line_no"))
