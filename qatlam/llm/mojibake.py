"""Text decoded with the wrong character encoding (problem 10).

Records are joined with clean near-twins at the level of word types, the largest unit that has twins in a corpus of
unique texts. Words are joined on what is left of them without non-ASCII characters; the two words of such a pair are
aligned at the ASCII characters, and the transformation is the one under which every sequence between them stands for its
counterpart. A word of which nothing is left when stripped meets instead the clean words that it equals once a candidate
transformation is undone, or, where letters were lost, once the stand-ins are. Aligning all twins yields the learned mapping:
which transformations occur, and which garbled sequence stands for which character under each. The mapping is then
applied to the words that have no twin. Passages of which only question marks are left can't be restored and are found by
their runs. Words are counted over all documents; only word types are shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qatlam.llm.fold import APOSTROPHES
from qatlam.runtime import cut, fits, spread

#: A clean twin stands in at least so many documents, and in RATIO times as many as the garbled word.
CLEAN_DOCS = 4
RATIO = 3
#: Twins (distinct garbled words) that a transformation needs before it is applied to words without a twin.
TWINS = 3
#: Garbled word types up to which they are sent to all executors.
SHIP_TYPES = 300_000

_EIGHT = ["koi8-r", "cp1251", "cp866", "iso8859-5", "mac-cyrillic", "cp1252", "cp1254"]
_WRONG = ["cp1252", "latin-1", "cp1251", "cp866", "koi8-r", "cp1254"]

#: Transformation name -> steps of (wrong encoding, true encoding) that undo it.
CHAINS: dict[str, list[tuple[str, str]]] = {f"utf-8 as {w}": [(w, "utf-8")] for w in _WRONG}
CHAINS |= {f"utf-8 as {w} twice": [(w, "utf-8")] * 2 for w in ("cp1252", "latin-1", "cp1251")}
CHAINS |= {f"{t} as {w}": [(w, t)] for t in _EIGHT for w in _EIGHT if t != w}
LOST = "lost letter"


def _bytes_of(codec: str) -> dict[str, int]:
    """Characters that the codec's decoder yields, bytes it leaves undefined standing for themselves."""
    out = {}
    for b in range(256):
        try:
            out[bytes([b]).decode(codec)] = b
        except UnicodeDecodeError:
            out[chr(b)] = b
    return out


_TABLES = {c: _bytes_of(c) for c in {w for steps in CHAINS.values() for w, _ in steps}}
_APOS = re.compile("[" + APOSTROPHES + "]")
_CORE = re.compile(r"[^\W\d_](?:['’‘ʻʼ`]?[^\W\d_])*")
_CYR, _LAT = re.compile("[Ѐ-ӿ]"), re.compile("[A-Za-zÀ-ɏ]")
_SIGNS = "’‘“”„«»–—…№ʻʼ´`\xa0"
_ODD = re.compile("[\x00-\x08\x0b-\x1f\x7f-\x9f�]")


def undo(text: str, chain: str) -> str | None:
    """``text`` before the transformation, or None where it can't be its result."""
    for wrong, true in CHAINS[chain]:
        table = _TABLES[wrong]
        try:
            text = bytes([table[c] for c in text]).decode(true)
        except (KeyError, UnicodeDecodeError):
            return None
    return text


def cores(token: str) -> list[str]:
    """Words within a token, in lower case and with plain apostrophes."""
    return [_APOS.sub("'", w.lower()) for w in _CORE.findall(token)]


def _plausible(token: str) -> bool:
    """Whether a restored token is made of letters and usual signs, its words in one script and in regular case."""
    if _ODD.search(token) or any(not (c.isascii() or c.isalpha() or c in _SIGNS) for c in token):
        return False
    for w in _CORE.findall(token):
        if (_CYR.search(w) and _LAT.search(w)) or any(a.islower() and b.isupper() for a, b in zip(w, w[1:])):
            return False
    return True


def restorations(token: str) -> Iterator[tuple[str, str]]:
    """(transformation, restored token) of all transformations that may have made ``token``."""
    if token.isascii():
        if re.search(r"[^\W\d_]\?{1,3}[^\W\d_]", token):
            yield LOST, re.sub(r"(?<=[^\W\d_])\?{1,3}(?=[^\W\d_])", "'", token)
        return
    for chain in CHAINS:
        t = undo(token, chain)
        if t is None or t == token or not _plausible(t):
            continue
        # eight-bit encodings map one character to one, and letters don't become signs
        if chain.startswith("utf-8") or (max(map(len, _CORE.findall(t)), default=0) >= 3 and sum(map(str.isalpha, t)) >= sum(map(str.isalpha, token))):
            yield chain, t


def aligned(token: str, restored: str, chain: str) -> list[tuple[str, str]]:
    """(garbled sequence, character) of each non-ASCII character of the restored token."""
    out = []
    for c in restored:
        if c.isascii():
            continue
        s = c
        for wrong, true in reversed(CHAINS[chain]):
            back = {b: x for x, b in _TABLES[wrong].items()}
            s = "".join(back[b] for b in s.encode(true, "ignore"))
        out.append((s, c))
    return out


_ASCII = re.compile("[\x00-\x7f]+")


@lru_cache(100_000)
def _explained(garbled: str, clean: str) -> frozenset[str]:
    """The transformations that turn ``clean`` into ``garbled``."""
    return frozenset(c for c in CHAINS if undo(garbled, c) == clean)


def inferred(token: str, twin: str) -> list[str]:
    """The transformations that turn ``twin`` into ``token``, by aligning them at their ASCII characters: the sequences
    between these must stand for each other. None where the ASCII characters differ."""
    if _ASCII.findall(token) != _ASCII.findall(twin):
        return []
    a, b = _ASCII.split(token), _ASCII.split(twin)
    if len(a) != len(b) or a == b:
        return []
    return sorted(frozenset.intersection(*[_explained(x, y) for x, y in zip(a, b) if x or y]))


_SPLIT = r"[ \t\r\n]+"
#: Four words and more in a row of which only question marks are left; signs and digits between them stay as they were.
#: Possessive, since Java matches other repeated groups by recursion, and a run of a thousand words overflowed the stack.
LOST_RUN = r"(?:(?:^|\s)[^\p{L}\s?]*\?[^\p{L}\s]*(?=\s|$)){4,}+"


def stripped_twins(types: DataFrame) -> DataFrame:
    """(token, chain, restored): words joined with far more common ones on their ASCII characters. ``types`` holds (token, n)."""
    core = F.regexp_replace("token", r"^[\x21-\x2f\x3a-\x40\x5b-\x60\x7b-\x7e]+|[\x21-\x2f\x3a-\x40\x5b-\x60\x7b-\x7e]+$", "")
    odd = types.where(F.col("token").rlike(r"[^\x00-\x7f]")).select("token", core.alias("core"), "n").withColumn("left", F.lower(F.regexp_replace("core", r"[^\x00-\x7f]+", "")))
    odd = odd.where("length(left) >= 3")
    # counted without the signs around a word, so that a clean word with rare signs isn't taken for its garbled form's garbling
    cores = odd.groupBy("left", "core").agg(F.sum("n").alias("docs"))
    clean = cores.where(F.col("docs") >= CLEAN_DOCS).select("left", F.col("core").alias("twin"), F.col("docs").alias("often"))
    pairs = cores.join(clean, "left").where((F.col("often") >= RATIO * F.col("docs")) & (F.col("core") != F.col("twin")))
    pairs = odd.join(pairs, ["left", "core"]).select("token", "core", "twin")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(t, c, t.replace(x, y)) for t, x, y in zip(b["token"], b["core"], b["twin"]) for c in inferred(x, y)]
            yield pd.DataFrame([r for r in rows if _plausible(r[2])], columns=["token", "chain", "restored"])

    return pairs.mapInPandas(run, "token string, chain string, restored string").distinct()


def tokens(documents: DataFrame) -> DataFrame:
    """(doc_id, token): the distinct tokens between ASCII spaces of each document; other spaces may be garbled letters."""
    return documents.where(F.col("text").isNotNull()).select("doc_id", F.explode(F.array_distinct(F.split("text", _SPLIT))).alias("token")).where("token <> ''")


def garbled_types(documents: DataFrame) -> DataFrame:
    """(token, chain, restored) of all garbled word types of ``documents``; restored is null where letters are gone."""
    types = cut(tokens(documents).groupBy("token").agg(F.count("*").alias("n")))

    def clean(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(c, n) for t, n in zip(b["token"], b["n"]) for c in set(cores(t))]
            yield pd.DataFrame(rows, columns=["core", "n"])

    def guesses(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for t, n in zip(b["token"], b["n"]):
                for chain, r in restorations(t):
                    cs = cores(r)
                    rows.extend((t, int(n), chain, r, c, len(c) / max(1, sum(map(len, cs)))) for c in cs)
            yield pd.DataFrame(rows, columns=["token", "n", "chain", "restored", "core", "share"])

    words = types.mapInPandas(clean, "core string, n bigint").groupBy("core").agg(F.sum("n").alias("docs")).where(F.col("docs") >= CLEAN_DOCS)
    words = cut(words)
    odd = types.where(F.col("token").rlike(r"[^\x00-\x7f]|\p{L}\?{1,3}\p{L}"))
    guess = cut(spread(odd, "token").mapInPandas(guesses, "token string, n bigint, chain string, restored string, core string, share double"))
    # how common the token's longest word is: a word that is common as it stands isn't garbled
    own = odd.mapInPandas(lambda bs: (pd.DataFrame([(t, max(cores(t), key=len)) for t in b["token"] if cores(t)], columns=["token", "core"]) for b in bs), "token string, core string")
    own = own.join(words, "core").groupBy("token").agg(F.max("docs").alias("own"))
    seen = guess.join(words, "core", "left").join(own, "token", "left")
    known = (F.col("docs") >= F.lit(RATIO) * F.coalesce("own", "n")).cast("double")
    per = seen.groupBy("token", "chain", "restored").agg(F.sum(F.col("share") * F.coalesce(known, F.lit(0.0))).alias("cover"), F.max("own").alias("own"), F.max("n").alias("n"))
    per = cut(per)
    twins = cut(per.where("cover >= 0.7").select("token", "chain", "restored").union(stripped_twins(types)).distinct())

    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(c, g, x) for t, c, r in zip(b["token"], b["chain"], b["restored"]) if c != LOST for g, x in aligned(t, r, c)]
            yield pd.DataFrame(rows, columns=["chain", "seq", "char"])

    # at most some hundred rows a transformation: its code table
    mapping = twins.mapInPandas(align, "chain string, seq string, char string").groupBy("chain", "seq", "char").agg(F.count("*").alias("n")).where("n >= 2").collect()
    support = {r["chain"] for r in twins.groupBy("chain").agg(F.count("*").alias("n")).where(F.col("n") >= TWINS).collect()}
    learned = {c: {r["seq"] for r in mapping if r["chain"] == c} for c in support if c != LOST}

    def rest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for t, c, r in zip(b["token"], b["chain"], b["restored"]):
                pairs = aligned(t, r, c) if c in learned else []
                if pairs and all(g in learned[c] for g, _ in pairs) and (c.startswith("utf-8") or sum(x.isalpha() for _, x in pairs) >= 4):
                    rows.append((t, c, r))
            yield pd.DataFrame(rows, columns=["token", "chain", "restored"])

    # words of eight-bit transformations without a twin are taken only where nothing speaks for them as they stand
    alone = per.where((F.col("cover") < 0.7) & (F.col("own").isNull() | F.col("chain").startswith("utf-8"))).mapInPandas(rest, "token string, chain string, restored string")
    both = twins.withColumn("rank", F.lit(0)).unionByName(alone.withColumn("rank", F.when(F.col("chain").startswith("utf-8"), 1).otherwise(2)))
    best = both.groupBy("token").agg(F.min(F.struct("rank", "chain", "restored")).alias("b")).select("token", "b.chain", "b.restored", "b.rank")
    gone = types.where(F.col("token").contains("�")).select("token", F.lit("replaced").alias("chain"), F.lit(None).cast("string").alias("restored"), F.lit(0).alias("rank"))
    return best.where(~F.col("token").contains("�")).unionByName(gone)


def garbled(documents: DataFrame) -> DataFrame:
    """(doc_id, token, chain, restored, rank) of all garbled tokens. Null and empty texts have none; repeated texts each
    count; entities, foreign names and repeated question marks are not garbled, since they have no clean twin."""
    types = cut(garbled_types(documents))
    odd = tokens(documents.where(F.col("text").rlike(r"[^\x00-\x7f]|\p{L}\?{1,3}\p{L}"))).where(F.col("token").rlike(r"[^\x00-\x7f]|\p{L}\?{1,3}\p{L}"))
    hits = odd.join(F.broadcast(types) if fits(types, SHIP_TYPES) else types, "token")
    gone = documents.where(F.contains("text", F.lit("?? ")) | F.contains("text", F.lit("??\n"))).select("doc_id", F.regexp_extract("text", LOST_RUN, 0).alias("token")).where("token <> ''")
    return hits.unionByName(gone.select("doc_id", "token", F.lit("only question marks").alias("chain"), F.lit(None).cast("string").alias("restored"), F.lit(0).alias("rank")))


def found(hits: DataFrame) -> DataFrame:
    """Documents with a garbled word that has a twin, or two that only the learned mapping explains."""
    d = hits.groupBy("doc_id").agg(F.min("rank").alias("rank"), F.count("*").alias("n"))
    return d.where("rank = 0 or (rank = 1 and n >= 1) or n >= 3").select("doc_id")


def restored(documents: DataFrame, hits: DataFrame) -> DataFrame:
    """(doc_id, text, restored_text, complete) of the documents found; ``complete`` is false where letters are gone."""
    per = hits.join(found(hits), "doc_id").groupBy("doc_id").agg(
        F.map_from_entries(F.collect_list(F.when(F.col("restored").isNotNull(), F.struct("token", "restored")))).alias("_map"),
        (F.count_if(F.col("restored").isNull()) == 0).alias("complete"))
    space = re.compile(r"[^ \t\r\n]+")

    @F.pandas_udf("string")
    def fix(texts: pd.Series, maps: pd.Series) -> pd.Series:
        return pd.Series([space.sub(lambda m, d=dict(d): d.get(m.group(0), m.group(0)), t) for t, d in zip(texts, maps)])

    return documents.select("doc_id", "text").join(per, "doc_id").select("doc_id", "text", fix("text", "_map").alias("restored_text"), "complete")
