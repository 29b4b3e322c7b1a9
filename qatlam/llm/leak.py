"""Evaluation passages inside training documents (problem 9).

A prefix-filtered set join. An item is the set of its four-word shingles. A window of 14 item words of which at most two are
changed or missing, or of 21 words and three, keeps so many of its shingles that a document that holds the window holds one of
the window's rarest ones, as many as may be broken and one more: only these are joined. (Longer stretches with one word in
seven changed hold such a window.) Positional and length bounds then discard most meetings, and an exact alignment over
windows of item size decides.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qatlam.llm.fold import words
from qatlam.runtime import cut

#: Words of a window and how many of them, one in seven, may be changed or missing.
SHAPES = ((14, 2), (21, 3))
WINDOW, MISSES = SHAPES[-1]
SIZE = 4  # words in a shingle; each miss breaks at most so many
#: Words of the items that are shipped to the executors at once; more go in parts, each of which passes over the documents.
SHIP_WORDS = 2_000_000
#: Meetings that are compared at once, in words of the longest item.
CELLS = 4_000_000

_OPTIONS = re.compile(r"\s[AАaа]\)\s")
_TASK = re.compile(r"^[^:?.!]{3,120}[:?]\s")


def head_of(text: str | None) -> tuple[str | None, int]:
    """The leading clause that ends in a colon or a question mark, folded, and where it ends."""
    m = _TASK.match(text or "")
    return (" ".join(words(m.group(0))), m.end()) if m else (None, 0)


def with_shared(items: DataFrame) -> DataFrame:
    """(item_id, text, shared): whether at least two items of all begin with the same clause (in any script)."""

    @F.pandas_udf("string")
    def head(texts: pd.Series) -> pd.Series:
        return pd.Series([head_of(t)[0] for t in texts], dtype=object)

    h = items.select("item_id", "text", head("text").alias("head"))
    more = h.where("head is not null").groupBy("head").agg(F.count("*").alias("n")).where("n > 1").select("head", F.lit(True).alias("shared"))
    return h.join(more, "head", "left").select("item_id", "text", F.coalesce("shared", F.lit(False)).alias("shared"))


def passages(items: pd.DataFrame) -> pd.DataFrame:
    """Item passages without task lines (leading clauses that are ``shared``) and answer options."""
    out = []
    for t, shared in zip(items["text"].fillna(""), items["shared"]):
        body = t[head_of(t)[1] :] if shared else t
        cut = list(_OPTIONS.finditer(body))
        out.append(body[: cut[-1].start()] if cut else body)
    return pd.DataFrame({"item_id": items["item_id"], "body": out})


class Items:
    """The passages as word codes with an index of their prefix shingles."""

    def __init__(self, bodies: pd.DataFrame):
        self.ids = bodies["item_id"].to_numpy()
        lists = [words(b) for b in bodies["body"]]
        vocabulary = sorted({w for ws in lists for w in ws})
        self.code = {w: i for i, w in enumerate(vocabulary)}
        self.base = np.int64(len(vocabulary) + 1)
        self.lists = [np.array([self.code[w] for w in ws], dtype=np.int64) for ws in lists]
        keys = [self.keys(c) for c in self.lists]
        rarity = Counter(int(k) for ks in keys for k in ks)
        rows: set[tuple[int, int, int]] = set()
        for n, ks in enumerate(keys):
            for window, misses in SHAPES:
                many = window - SIZE + 1
                for s in range(max(0, len(self.lists[n]) - window + 1)):
                    order = sorted(range(s, s + many), key=lambda i: (rarity[int(ks[i])], int(ks[i])))
                    rows.update((int(ks[i]), n, i) for i in order[: misses * SIZE + 1])
        table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 3)
        self.key, self.item, self.at = table[:, 0], table[:, 1], table[:, 2]
        pad = max((len(c) for c in self.lists), default=0) + 4 * WINDOW
        self.padded = np.full((len(self.lists), pad), -2, dtype=np.int64)
        for n, c in enumerate(self.lists):
            self.padded[n, WINDOW * 2 : WINDOW * 2 + len(c)] = c

    def keys(self, codes: np.ndarray) -> np.ndarray:
        """Keys of all shingles; -1 where a word is unknown. 64-bit wrap-around only adds meetings, never loses one."""
        if len(codes) < SIZE:
            return np.zeros(0, dtype=np.int64)
        with np.errstate(over="ignore"):
            k = codes[: len(codes) - SIZE + 1].copy()
            ok = k >= 0
            for j in range(1, SIZE):
                nxt = codes[j : len(codes) - SIZE + 1 + j]
                ok &= nxt >= 0
                k = k * self.base + nxt
        k &= np.int64(2**62 - 1)
        k[~ok] = -1
        return k


def _aligned(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether a window of ``a`` has all but its misses, in order, in a stretch of ``b`` that is no longer than the window and
    its misses."""
    for window, misses in SHAPES:
        need = window - misses
        for s in range(len(a) - window + 1):
            w = a[s : s + window]
            if np.isin(w, b).sum() < need:
                continue
            for t in range(max(1, len(b) - need + 1)):
                seg = b[t : t + window + misses]
                if len(seg) < need:
                    break
                row = np.zeros(len(seg) + 1, dtype=np.int64)
                for x in w:
                    nxt = np.maximum(row[1:], row[:-1] + (seg == x))
                    row = np.concatenate(([0], np.maximum.accumulate(nxt)))
                if row[-1] >= need:
                    return True
    return False


def _near(index: Items, codes: np.ndarray, hit: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positional bound, vectorised: around each meeting, words of the item that also stand within MISSES places of
    their diagonal in the document; a window can only match where all but its misses do. The second result tells
    where they all stand on the diagonal itself, which already is a match."""
    span = np.arange(-WINDOW, WINDOW + SIZE)
    rows = index.padded[index.item[entry]]
    cols = index.at[entry][:, None] + 2 * WINDOW + span
    mine = np.take_along_axis(rows, cols, axis=1)
    there = hit[:, None] + span

    def dense(seen: np.ndarray) -> np.ndarray:
        c = np.concatenate([np.zeros((len(seen), 1), dtype=np.int64), np.cumsum(seen & (mine >= 0), axis=1)], axis=1)
        return np.any([(c[:, w:] - c[:, :-w]).max(axis=1) >= w - m for w, m in SHAPES], axis=0)

    straight = codes[there] == mine
    seen = straight.copy()
    for shift in range(-MISSES, MISSES + 1):
        seen |= codes[there + shift] == mine
    return dense(seen), dense(straight)


def _matches(index: Items, ids: np.ndarray, texts: list[str | None]) -> tuple[list[int], list[int]]:
    lists = [words(t) if t else [] for t in texts]
    get, gap = index.code.get, [-1] * (3 * WINDOW)
    flat: list[int] = list(gap)
    bounds = []
    for ws in lists:
        bounds.append(len(flat))
        flat.extend([get(w, -1) for w in ws])
        flat.extend(gap)
    codes = np.array(flat, dtype=np.int64)
    keys = index.keys(codes)
    first = np.searchsorted(index.key, keys, "left")
    count = np.searchsorted(index.key, keys, "right") - first
    count[keys < 0] = 0
    pos = np.flatnonzero(count)
    found_doc: list[int] = []
    found_item: list[int] = []
    done: set[tuple[int, int]] = set()
    offsets = np.array(bounds)
    step = max(1, CELLS // index.padded.shape[1]) if len(index.ids) else 1
    for lo in range(0, len(pos), step):
        part = pos[lo : lo + step]
        hit = np.repeat(part, count[part])
        within = np.arange(len(hit)) - np.repeat(np.cumsum(count[part]) - count[part], count[part])
        entry = first[hit] + within
        keep, sure = _near(index, codes, hit, entry)
        for p, e, certain in zip(hit[keep], entry[keep], sure[keep]):
            d = int(np.searchsorted(offsets, p, "right") - 1)
            n, q = int(index.item[e]), int(index.at[e])
            if (d, n) in done:
                continue
            a = index.lists[n][max(0, q - WINDOW + SIZE) : q + WINDOW]
            b = codes[p - WINDOW - MISSES : p + WINDOW + SIZE + MISSES]
            if certain or _aligned(a, b):
                done.add((d, n))
                found_doc.append(int(ids[d]))
                found_item.append(int(index.ids[n]))
    return found_doc, found_item


def leaked(documents: DataFrame, items: DataFrame, ship_words: int = SHIP_WORDS) -> DataFrame:
    """(doc_id, item_id) of every document that holds at least 14 consecutive words of an item, one in seven of which
    may be changed or missing. Null and empty texts match nothing; repeated documents each match; columns other than
    the key and ``text`` are ignored. Items with no text or fewer than 14 words are never found.

    Items within ``ship_words`` words go to the executors and the documents are read once, without a shuffle. A larger
    item set is cut into parts of that size, each of which passes over the documents.
    """
    spark = documents.sparkSession
    known = cut(with_shared(items))
    n = int(known.select(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0] / 5 // ship_words) + 1
    out = None
    for k in range(n):
        part = known.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == k)
        index = spark.sparkContext.broadcast(Items(passages(part.toPandas())))

        def run(batches: Iterator[pd.DataFrame], index=index) -> Iterator[pd.DataFrame]:
            for b in batches:
                d, i = _matches(index.value, b["doc_id"].to_numpy(), [None if x is None or x != x else x for x in b["text"]])
                yield pd.DataFrame({"doc_id": pd.array(d, dtype="int64"), "item_id": pd.array(i, dtype="int64")})

        found = documents.select("doc_id", "text").where(F.col("text").isNotNull()).mapInPandas(run, "doc_id bigint, item_id bigint")
        out = found if out is None else out.unionByName(found)
    return out
