"""Repair of text from scanned pages (problem 5).

Running headers, footers and page numbers are found at the edges of pages, the headers by their repetition within a book.
Words broken at line ends are joined, also overleaf. Word types are counted over all pages; each type is looked up in a trie
of the words that are far more common, by running the Levenshtein automaton of the type (bit-parallel, one word of bits per
number of errors) along the trie, so that all candidates within the distance come out. Where a type has several, those that
stand beside the same words elsewhere come first, then those that scans confuse, then fewer edits and higher frequency.
Texts are read in three streaming passes; words, edge lines and candidates are shuffled, and each page gets the corrections
of its own words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from qatlam.llm.fold import APOSTROPHES
from qatlam.runtime import cut, fits, spread

#: A word is misread if a word within the distance is so many times as common: where scans confuse the two, else in words
#: of five letters and more.
RATIO, FAR_RATIO = 5, 40
#: Words of the vocabulary that are sent to the executors at once; more go in parts. About 16 bytes a word are sent, and a worker's
#: trie takes some hundred times as much.
SHIP_TYPES = 200_000
EDGE = 3

_APOS = re.compile("[" + APOSTROPHES + "]")
_WORD = re.compile(r"[^\W_]+(?:[" + APOSTROPHES + r"|][^\W_]+)*[" + APOSTROPHES + r"]?")
_HYPHEN = re.compile(r"([^\W_](?:[^\W_]|[" + APOSTROPHES + r"|])*)[-¬­‐‑–]\s*$")
HYPHENS = set("-¬\xad‐‑–")
_START = re.compile(r"^\s*([^\W_](?:[^\W_]|[" + APOSTROPHES + r"|])*)")
_COMPOUND = re.compile(r"([^\W_](?:[^\W_]|[" + APOSTROPHES + r"])*)[-‐‑]([^\W_](?:[^\W_]|[" + APOSTROPHES + r"])*)")
#: Page numbers, with the letters that scans put for digits.
_NUMBER = re.compile(r"^\W*(?=.*[0-9|IO])[0-9IlOoSsBZi|]{1,4}\W*(?:bet|b\.)?\W*$")
_SIDE = re.compile(r"^\s*\W?[0-9IlOSBZ|]{1,4}\W?\s{2,}(?=\S)|(?<=\S)\s{2,}\W?[0-9IlOSBZ|]{1,4}\W?\s*$")

#: What scans confuse, besides digits for letters and letters of other scripts.
CONFUSED = {("n", "ri"), ("m", "rn"), ("d", "cl"), ("u", "ii"), ("h", "li"), ("t", "f"), ("e", "c"), ("l", "1"), ("l", "|"), ("i", "1"), ("o", "0"), ("s", "5"), ("b", "6"), ("g", "9"),
            ("v", "y"), ("h", "b"), ("q", "k"), ("h", "x"), ("i", "y"), ("g'", "g"), ("o'", "o"), ("o'", "u")}


def norm(word: str) -> str:
    w = word.lower()
    return w if w.isascii() and w.isalpha() else _APOS.sub("'", w).strip("'")


def header_key(line: str) -> str:
    """Letters of a line at the edge of a page without the page number beside them."""
    return "".join(c for c in norm(_SIDE.sub("", line)) if c.isalpha())


def alike(key: str, header: str) -> bool:
    """Whether a line's letters are a header's, perhaps misread."""
    return key == header or (abs(len(key) - len(header)) <= 3 and SequenceMatcher(None, key, header, autojunk=False).ratio() >= 0.8)


def is_furniture(line: str, headers: list[str], edge: bool) -> bool:
    """Whether a line at a page's edge is a page number or has the letters of one of ``headers``."""
    if not edge:
        return False
    return bool(_NUMBER.match(line.strip())) or header_key(line) in headers


def furniture_lines(lines: list[str], headers: list[str]) -> set[int]:
    """Numbers of the furniture lines: from either edge inwards, as long as lines are furniture."""
    filled = [i for i, x in enumerate(lines) if x.strip()]
    out: set[int] = set()
    for side in (filled[:EDGE], filled[::-1][:EDGE]):
        for i in side:
            if i in out or not is_furniture(lines[i], headers, True):
                break
            out.add(i)
    return out


def _halves(line: str | None, after: str | None, compounds: set[str]) -> tuple[str, str] | None:
    """The two parts of a word broken at the end of ``line``; None for words always written with a hyphen."""
    # most lines end otherwise, and the pattern would try each of their words
    if not line or not after or line.rstrip()[-1:] not in HYPHENS:
        return None
    a, b = _HYPHEN.search(line), _START.match(after)
    if a and b and b.group(1)[0].islower() and not a.group(1)[-1].isdigit():
        x, y = norm(a.group(1)), norm(b.group(1))
        if f"{x}-{y}" not in compounds and not (len(x) > 2 and y.startswith(x)):
            return a.group(1), b.group(1)
    return None


class Page:
    """A page's text lines, and its last line joined with the next page where a word goes on there."""

    def __init__(self, text: str, headers: list[str], beyond: str | None, compounds: set[str], behind: str | None = None):
        self.lines = text.split("\n")
        self.furniture = furniture_lines(self.lines, headers)
        self.body = [i for i, x in enumerate(self.lines) if x.strip() and i not in self.furniture]
        self.broken: dict[int, tuple[str, str]] = {}
        for n, i in enumerate(self.body):
            parts = _halves(self.lines[i], self.lines[self.body[n + 1]] if n + 1 < len(self.body) else beyond, compounds)
            if parts:
                self.broken[i] = parts
        #: The word that the page before has begun.
        self.begun = _halves(behind, self.lines[self.body[0]], compounds) if self.body else None

    def words(self) -> Iterator[tuple[int, int, str]]:
        """(line, line of the word's second part or -1, word) in order. A word that goes on overleaf (-2) counts here and not
        on the next page."""
        carried = self.begun is not None
        for n, i in enumerate(self.body):
            ws = _WORD.findall(self.lines[i])
            if carried and ws:
                ws = ws[1:]
            carried = i in self.broken
            if carried and ws:
                ws = ws[:-1]
            for w in ws:
                yield i, -1, w
            if carried:
                a, b = self.broken[i]
                yield i, self.body[n + 1] if n + 1 < len(self.body) else -2, a + b


class Trie:
    """Words with counts; ``near`` gives all words within ``k`` edits of a word that are common enough."""

    def __init__(self, words: list[tuple[str, int]]):
        self.root: list = [{}, 0, 0]
        for w, n in words:
            node = self.root
            node[2] = max(node[2], n)
            for c in w:
                node = node[0].setdefault(c, [{}, 0, 0])
                node[2] = max(node[2], n)
            node[1] = n

    def near(self, word: str, k: int, least: int) -> list[tuple[str, int, int]]:
        """(candidate, count, edits). The automaton's states are k + 1 bit masks: bit i of mask e is set when i letters of
        ``word`` are read with e edits."""
        m = len(word)
        masks: dict[str, int] = {}
        for i, c in enumerate(word):
            masks[c] = masks.get(c, 0) | 1 << i
        full, end = (1 << (m + 1)) - 1, 1 << m
        start = tuple((1 << (e + 1)) - 1 & full for e in range(k + 1))
        out: list[tuple[str, int, int]] = []
        stack = [(self.root, "", start)]
        while stack:
            node, prefix, state = stack.pop()
            for c, child in node[0].items():
                if child[2] < least:
                    continue
                hit = masks.get(c, 0)
                before = state[0]
                now = (before & hit) << 1
                nxt = [now]
                alive = now
                for e in range(1, k + 1):
                    now = ((state[e] & hit) << 1 | before | before << 1 | now << 1) & full
                    before = state[e]
                    nxt.append(now)
                    alive |= now
                if not alive:
                    continue
                p = prefix + c
                if child[1] >= least:
                    for e, s in enumerate(nxt):
                        if s & end:
                            if e:
                                out.append((p, child[1], e))
                            break
                stack.append((child, p, tuple(nxt)))
        return out


def confusion(word: str, candidate: str) -> bool:
    """Whether the difference is one that scans make."""
    for right, wrong in CONFUSED:
        if len(wrong) > 1 and wrong in word and any(candidate == word[:i] + right + word[i + len(wrong) :] for i in range(len(word)) if word.startswith(wrong, i)):
            return True
    if len(word) == len(candidate):
        parts = [(x, y) for x, y in zip(candidate, word) if x != y]
    else:
        parts = [(candidate[a:b], word[c:d]) for op, a, b, c, d in SequenceMatcher(None, candidate, word, autojunk=False).get_opcodes() if op != "equal"]
    for right, wrong in parts:
        odd = any(c.isdigit() or c == "|" or ord(c) > 0x24F for c in wrong)
        pair = (right, wrong) in CONFUSED or (wrong, right) in CONFUSED
        near = any((r, w) in CONFUSED or (w, r) in CONFUSED for r, w in ((right + "'", wrong + ""), (right, wrong + "'"))) or (right, wrong) in {("'", ""), ("", "'")}
        if not (odd or pair or near):
            return False
    return True


def corrections(word: str, n: int, trie: Trie) -> list[tuple[str, int, int, int]]:
    """(candidate, count, edits, 0 if scans confuse it so, else 1) of all words within one edit, and within two of words of five
    letters and more, that are so much more common; none for a word read rightly."""
    odd = any(c.isdigit() or c == "|" or ord(c) > 0x24F for c in word)
    if len(word) < (2 if odd else 3) or word.isdigit():
        return []
    near = [(w, c, e, 0 if confusion(word, w) else 1) for w, c, e in trie.near(word, 2 if len(word) >= 5 else 1, (3 if odd else RATIO) * n)]
    return [x for x in near if odd or x[3] == 0 or (x[2] == 1 and len(word) >= 5 and x[1] >= FAR_RATIO * n)]


def with_context(pages: DataFrame) -> DataFrame:
    """(ocr_id, path, page, text, headers, beyond, behind): each page with those of its edge lines' keys that are running
    headers of its book, the next page's first text line and the last one of the page before. A book has any number of
    headers; no row holds more of them than its page has edge lines."""
    p = pages.where(F.col("text").isNotNull()).select("ocr_id", "path", "page", "text")
    filled = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"\S"))
    edges = cut(p.select("ocr_id", "path", "page", F.slice(filled, 1, EDGE).alias("top"), F.reverse(F.slice(F.reverse(filled), 1, EDGE)).alias("bottom")))

    @F.pandas_udf("array<struct<key:string,near:boolean>>")
    def keys(top: pd.Series, bottom: pd.Series) -> pd.Series:
        out = []
        for a, b in zip(top, bottom):
            near = {header_key(x) for x in [*a[:2], *b[-2:]]}
            out.append([{"key": k, "near": k in near} for k in sorted({header_key(x) for x in [*a, *b]} - {""})])
        return pd.Series(out, dtype=object)

    lines = cut(edges.select("path", "page", F.inline(keys("top", "bottom"))))
    types = cut(lines.groupBy("path", "key").agg(F.count_if("near").alias("n")).withColumn("size", F.length("key")))
    repeated = types.where("n >= 2 and size >= 4").select("path", F.col("key").alias("header"), F.col("size").alias("header_size"))
    # misread ones: of similar length, and as many edits at most as the ratio of like letters allows
    banded = repeated.withColumn("size", F.explode(F.sequence(F.col("header_size") - 3, F.col("header_size") + 3)))
    close = types.join(banded, ["path", "size"]).where(F.levenshtein("key", "header") <= 0.2 * (F.col("size") + F.col("header_size")) + 1e-6)

    @F.pandas_udf("boolean")
    def similar(key: pd.Series, header: pd.Series) -> pd.Series:
        return pd.Series([alike(k, h) for k, h in zip(key, header)], dtype=bool)

    known = close.where(similar("key", "header")).select("path", "key").distinct()
    heads = cut(lines.join(known, ["path", "key"]).groupBy("path", "page").agg(F.sort_array(F.collect_set("key")).alias("headers")))

    def outer(lines: pd.Series, headers: pd.Series, order: int) -> pd.Series:
        out = []
        for t, h in zip(lines, headers):
            f = furniture_lines(list(t), list(h) if h is not None else [])
            out.append(next((x for i, x in list(enumerate(t))[::order] if i not in f), None))
        return pd.Series(out, dtype=object)

    @F.pandas_udf("string")
    def first(lines: pd.Series, headers: pd.Series) -> pd.Series:
        return outer(lines, headers, 1)

    @F.pandas_udf("string")
    def last(lines: pd.Series, headers: pd.Series) -> pd.Series:
        return outer(lines, headers, -1)

    around = cut(edges.join(heads, ["path", "page"], "left").select("path", "page", first("top", "headers").alias("first"), last("bottom", "headers").alias("last")))
    after = around.select("path", (F.col("page") - 1).alias("page"), F.col("first").alias("beyond"))
    before = around.select("path", (F.col("page") + 1).alias("page"), F.col("last").alias("behind"))
    return p.join(heads, ["path", "page"], "left").join(after, ["path", "page"], "left").join(before, ["path", "page"], "left")


def _pages(b: pd.DataFrame) -> Iterator[tuple[int, Page]]:
    for i, t, h, y, x, c in zip(b["ocr_id"], b["text"], b["headers"], b["beyond"], b["behind"], b["compounds"]):
        yield i, Page(t, [] if h is None else list(h), y if isinstance(y, str) else None, set() if c is None else set(c), x if isinstance(x, str) else None)


def with_compounds(pages: DataFrame) -> DataFrame:
    """``pages`` with ``compounds``: of the words that may be broken at the ends of a page's lines those that are always written
    with a hyphen, seen so within lines of at least three pages."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for i, page in _pages(b.assign(compounds=None)):
                text = "\n".join(page.lines)
                rows.extend((i, False, w) for w in {f"{norm(x)}-{norm(y)}" for x, y in _COMPOUND.findall(text) if not x[-1].isdigit()})
                broken = [*page.broken.values(), *([page.begun] if page.begun else [])]
                rows.extend((i, True, w) for w in {f"{norm(x)}-{norm(y)}" for x, y in broken})
            yield pd.DataFrame(rows, columns=["ocr_id", "broken", "word"])

    seen = cut(pages.mapInPandas(run, "ocr_id bigint, broken boolean, word string"))
    known = seen.where("not broken").groupBy("word").agg(F.count("*").alias("n")).where("n >= 3").select("word")
    hits = cut(seen.where("broken").join(known, "word", "left_semi").groupBy("ocr_id").agg(F.collect_set("word").alias("compounds")))
    return pages.join(F.broadcast(hits) if fits(hits, SHIP_TYPES) else hits, "ocr_id", "left")


def page_words(pages: DataFrame) -> DataFrame:
    """(ocr_id, words, begun): the words of each page in order in one spelling, and the word begun on the page before."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(i, [w for w in (norm(w) for _, _, w in p.words()) if w], norm("".join(p.begun)) if p.begun else None) for i, p in _pages(b)]
            yield pd.DataFrame(rows, columns=["ocr_id", "words", "begun"])

    return pages.mapInPandas(run, "ocr_id bigint, words array<string>, begun string")


def misread_types(types: DataFrame) -> DataFrame:
    """(word, candidate, n, edits, odd) of all types taken as misread, with all their candidates. The vocabulary is the
    types common enough to correct any other; it goes to the executors in parts of SHIP_TYPES words, whose candidates add up."""
    vocabulary = cut(types.where((F.col("n") >= 3) & ~F.col("word").rlike(r"\d|\|")))
    k = vocabulary.count() // SHIP_TYPES + 1
    out = None
    for i in range(k):
        trie = types.sparkSession.sparkContext.broadcast([(r["word"], r["n"]) for r in vocabulary.where(F.pmod(F.xxhash64("word"), F.lit(k)) == i).collect()])

        def run(batches: Iterator[pd.DataFrame], words=trie) -> Iterator[pd.DataFrame]:
            t = Trie(words.value)
            for b in batches:
                rows = [(w, *c) for w, n in zip(b["word"], b["n"]) for c in corrections(w, n, t)]
                yield pd.DataFrame(rows, columns=["word", "candidate", "n", "edits", "odd"])

        found = spread(types, "word").mapInPandas(run, "word string, candidate string, n bigint, edits int, odd int")
        out = found if out is None else out.unionByName(found)
    return out


def page_fixes(words: DataFrame, misread: DataFrame) -> DataFrame:
    """(ocr_id, fixes): of each page a map from its misread words to their candidates. Of several candidates the one comes first
    that stands most often beside the words that stand beside the misread one on the page."""
    rank = F.row_number().over(Window.partitionBy("word").orderBy("odd", "edits", F.desc("n"), "candidate"))
    ranked = cut(misread.withColumn("rank", rank).withColumn("several", F.count("*").over(Window.partitionBy("word")) > 1))
    ids = ranked.select("word", "several").distinct()
    ids = F.broadcast(ids) if fits(ids, SHIP_TYPES) else ids
    all_ = F.concat(F.array(F.lit("")), "words", F.array(F.lit("")), F.when(F.col("begun").isNotNull(), F.array("begun", F.lit(""))).otherwise(F.array()))
    at = words.select("ocr_id", F.posexplode(all_).alias("pos", "word"), all_.alias("_all")).where("word <> ''").join(ids, "word")
    beside = F.array(F.get("_all", F.col("pos") - 1), F.get("_all", F.col("pos") + 1))
    at = cut(at.select("ocr_id", "word", "several", beside.alias("beside")))
    # pairs of neighbours that decide between candidates, counted over all pages
    cases = at.where("several").select("ocr_id", "word", F.posexplode("beside").alias("side", "by")).where("by <> ''").join(ranked.select("word", "candidate"), "word")
    pair = F.when(F.col("side") == 0, F.concat_ws(" ", "by", "candidate")).otherwise(F.concat_ws(" ", "candidate", "by"))
    cases = cut(cases.select("ocr_id", "word", "candidate", pair.alias("pair")))
    pairs = words.select(F.explode(F.zip_with(F.slice("words", 1, F.greatest(F.size("words") - 1, F.lit(0))), F.slice("words", 2, 1 << 30), lambda a, b: F.concat_ws(" ", a, b))).alias("pair"))
    counts = pairs.join(cases.select("pair").distinct(), "pair", "left_semi").groupBy("pair").agg(F.count("*").alias("times"))
    score = cases.join(counts, "pair", "left").groupBy("ocr_id", "word", "candidate").agg(F.coalesce(F.sum("times"), F.lit(0)).alias("score"))
    pages = at.select("ocr_id", "word").distinct().join(ranked, "word").join(score, ["ocr_id", "word", "candidate"], "left")
    best = pages.groupBy("ocr_id", "word").agg(F.max(F.struct(F.coalesce("score", F.lit(0)).alias("score"), (-F.col("rank")).alias("rank"), "candidate")).alias("b"))
    return best.groupBy("ocr_id").agg(F.map_from_entries(F.collect_list(F.struct("word", "b.candidate"))).alias("fixes"))


class Repaired:
    """The stages up to the corrections, shared by the queries on findings and on text. A page's row holds what it needs of
    others: its headers, its neighbours' lines, its compounds and its words' corrections."""

    def __init__(self, pages: DataFrame):
        p = cut(with_compounds(cut(with_context(pages))))
        words = cut(page_words(p))
        types = words.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
        self.misread = cut(misread_types(cut(types)))
        self.pages = p.join(page_fixes(words, self.misread), "ocr_id", "left")

    def findings(self) -> DataFrame:
        """(ocr_id, line_no, kind); a line that is furniture has no other kind."""
        return self.pages.mapInPandas(Repaired._find, "ocr_id bigint, line_no bigint, kind string")

    @staticmethod
    def _find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for (i, page), fixes in zip(_pages(b), b["fixes"]):
                best = _dict(fixes)
                rows.extend((i, n, "furniture") for n in page.furniture)
                rows.extend((i, n, "broken_word") for n in page.broken)
                bad = set()
                words = [*page.words()] if best else []
                if page.begun:
                    words.append((-1, page.body[0], "".join(page.begun)))
                for n, m, w in words:
                    fix = best.get(norm(w))
                    if fix is None:
                        continue
                    if m == -1:
                        bad.add(n)
                        continue
                    # which part of a broken word is wrong
                    head = page.broken[n][0] if n >= 0 else page.begun[0]
                    bad.add(n if _wrong_at(w, fix) < len(norm(head)) else m)
                rows.extend((i, n, "misread") for n in bad - {-1, -2})
            yield pd.DataFrame(rows, columns=["ocr_id", "line_no", "kind"])

    def text(self) -> DataFrame:
        """(ocr_id, path, page, paragraphs): the page as paragraphs without furniture, with words joined and corrected."""

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                rows = [(i, p, q, reflow(page, _dict(f))) for (i, page), p, q, f in zip(_pages(b), b["path"], b["page"], b["fixes"])]
                yield pd.DataFrame(rows, columns=["ocr_id", "path", "page", "paragraphs"])

        return self.pages.mapInPandas(run, "ocr_id bigint, path string, page int, paragraphs array<string>")


def _dict(fixes) -> dict[str, str]:
    return {} if fixes is None else dict(fixes)


def _wrong_at(word: str, fix: str) -> int:
    """Where the misread word first differs from its correction."""
    w = norm(word)
    return next((k for k, (x, y) in enumerate(zip(w, fix)) if x != y), min(len(w), len(fix)) - 1)


def _fixed(word: str, best: dict[str, str]) -> str:
    fix = best.get(norm(word))
    if fix is None:
        return word
    sign = next((c for c in word if c in APOSTROPHES), "'")
    fix = fix.replace("'", sign)
    return fix.upper() if len(word) > 1 and word.isupper() else fix[:1].upper() + fix[1:] if word[:1].isupper() else fix


def reflow(page: Page, best: dict[str, str]) -> list[str]:
    """Paragraphs of a page. A blank line, an indent or a short line that ends a sentence ends a paragraph."""
    out: list[str] = []
    text, last = "", -1
    width = max((len(page.lines[i].strip()) for i in page.body), default=0)
    for i in page.body:
        raw = page.lines[i]
        gap = last >= 0 and i > last + 1 and not any(k in page.furniture for k in range(last + 1, i))
        ended = last >= 0 and page.lines[last].rstrip()[-1:] in ".!?…" and len(page.lines[last].strip()) < 0.75 * width
        if text and last not in page.broken and (gap or ended or (raw[:3].isspace() and text.rstrip()[-1:] in ".!?…")):
            out.append(text.strip())
            text = ""
        line = re.sub(r"\s+", " ", raw.strip())
        if page.begun and i == page.body[0]:
            line = _START.sub("", line, count=1).strip()
        if last in page.broken and text:
            a, b = page.broken[last]
            rest = _START.sub("", line, count=1)
            text = text[: len(text) - len(a)] + _fixed(a + b, best) + _WORD.sub(lambda m: _fixed(m.group(0), best), rest)
        else:
            text += (" " if text else "") + _WORD.sub(lambda m: _fixed(m.group(0), best), line)
        if i in page.broken:
            a, b = page.broken[i]
            text = re.sub(r"[^\W_](?:[^\W_]|[" + APOSTROPHES + r"|])*[-¬­‐‑–]\s*$", "", text) + a
        last = i
    if last in page.broken and text:
        a, b = page.broken[last]
        text = text[: len(text) - len(a)] + _fixed(a + b, best)
    if text.strip():
        out.append(text.strip())
    return out
