"""Duplicates of new texts among everything accepted before (problem 7).

A text is the multiset of its words; the metric is the size of the symmetric difference of two multisets. The table keeps of
every accepted text its distances to fixed pivots: to the empty text, which is the number of words, and, with the words dealt
into ``CELLS`` cells by hash, the parity of its distance to the empty text within each cell. By the triangle inequality the
difference of two texts' distances to a pivot is a lower bound of their own, and so is the number of cells whose parities
differ.

Which texts are compared at all is decided by a prefix filter over runs of consecutive words (grams): all grams have one
order, rare ones first, and of two texts that differ by no more words than the tolerance, each has one of its first grams in
common with the first ones of the other, as many as may be missing and one more. Rows of one gram lie together, sorted by
the distance to the empty text, and each meets those within the range that the tolerance leaves it. So no copy is missed that
keeps the order of its words. What passes the bounds is verified by the true distance.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qatlam.llm import codes
from qatlam.llm.fold import plain_words
from qatlam.runtime import cut, fits

CELLS = 1024
#: Share of a text's words that its copy may have changed.
TOLERANCE = 0.125
#: Words that a copy may have more or less at its ends, besides.
ENDS = 6
#: Words in a gram. Texts of SHORT words at most have grams of two words, and those of LONG words at least, which a copy of any
#: longer text has, grams of four: one changed word may break all of a short text's longer grams.
WIDTHS, SHORT, LONG = (2, 4), 48, 25
#: Words whose frequency orders the grams; all others count as rarer. Any fixed order gives the same result.
FREQUENT = 200_000
#: Rows under one gram whose pairs leave the task unpruned; more are compared with their cells at hand.
RUN = 8
#: Rows under one gram that one task compares; more are split into blocks of so many, each of which meets each other.
BLOCK = 20_000
#: Pairs that are compared at once.
PAIRS = 500_000
#: Ids of texts to verify up to which they are broadcast (8 bytes each).
SHIP_IDS = 1_000_000
SALT = 8
#: Characters of texts that are worked on together.
CHUNK = 100_000
#: Bits of the bitmap of a batch's grams, as a power of 2: 8 MB.
BITS = 26
#: A folder of the history's texts holds 2 to this power ids.
FOLDER_BITS = 16

_SIG = "id bigint, h1 bigint, h2 bigint, n int, prefix array<bigint>, parities binary"
#: A key is the hash of a gram above the text's number of words, in so many bits (greater numbers count as the greatest), so
#: rows sorted by key are sorted by gram and number of words.
N_BITS = 16
N_MOST = (1 << N_BITS) - 1


def missing(n):
    """How many of its ``n`` words a text may lack in its copy."""
    return np.floor(TOLERANCE * n + 1e-9) + ENDS * (n > 4 * ENDS)


def lost(n, width: int):
    """How many of its grams a text of ``n`` words may lack then: a changed word breaks ``width`` of them, one at an end one."""
    return width * np.floor(TOLERANCE * n + 1e-9) + ENDS * (n > 4 * ENDS)


def same_text(a: str, b: str) -> bool:
    """Whether the multisets of words differ by no more than the tolerance on either side."""
    x, y = Counter(plain_words(a)), Counter(plain_words(b))
    return (x - y).total() <= missing(x.total()) and (y - x).total() <= missing(y.total())


def _chunks(texts: pd.Series) -> Iterator[slice]:
    total = texts.str.len().cumsum().to_numpy() // CHUNK
    ends = [*(np.flatnonzero(total[1:] != total[:-1]) + 1), len(texts)] if len(texts) else []
    for a, b in zip([0, *ends], ends):
        yield slice(a, b)


def word_order(texts: DataFrame) -> DataFrame:
    """(word, n) of the FREQUENT most frequent words (as hashes), counted by occurrence over all texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for part in _chunks(b["text"]):
                word, n = np.unique(codes.words(b["text"][part].tolist())[0], return_counts=True)
                yield pd.DataFrame({"word": word.view(np.int64), "n": n})

    counted = texts.where(F.col("text").isNotNull()).select("text").mapInPandas(run, "word bigint, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(FREQUENT)


def _told_apart(h: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes sorted by owner with the number of earlier equal ones mixed in, so a multiset is a set; and the sorting order."""
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    at = np.arange(len(h))
    begin = np.append(True, (h[1:] != h[:-1]) | (owner[1:] != owner[:-1]))[: len(h)]
    turn = at - np.maximum.accumulate(np.where(begin, at, 0))
    with np.errstate(over="ignore"):
        return codes.mixed(h + turn.astype(np.uint64) * codes.ODD), order


def _first_grams(h: np.ndarray, often: np.ndarray, rank: np.ndarray, first: np.ndarray, size: np.ndarray, width: int, out: list[list[int]]) -> None:
    """Adds to ``out`` the hashes of the first grams of each text (of number ``rank``) that has grams of ``width`` words."""
    mine = (size <= SHORT) if width == WIDTHS[0] else (size >= LONG)
    left = np.repeat(first + size, size) - np.arange(len(h))
    # a text of fewer words than a gram has one of all its words
    start = np.flatnonzero(np.repeat(mine, size) & ((left >= width) | ((left == np.repeat(size, size)) & (left < width))))
    if not len(start):
        return
    g, rare = np.full(len(start), width, dtype=np.uint64), np.ones(len(start))
    with np.errstate(over="ignore"):
        for k in range(width):
            there, here = left[start] > k, np.minimum(start + k, len(h) - 1)
            g = np.where(there, codes.mixed(g * np.uint64(3) + h[here]), g)
            rare *= np.where(there, often[here], 1)
    owner = rank[start]
    g, order = _told_apart(g, owner)
    owner, rare = owner[order], rare[order]
    order = np.lexsort((g, rare, owner))
    g, owner = g[order].view(np.int64), owner[order]
    edge = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    keep = (lost(size[owner[edge]], width) + 1).astype(np.int64)
    g = (g >> N_BITS << N_BITS) | np.minimum(size[owner], N_MOST)
    for r, a, e, k in zip(owner[edge], edge, np.append(edge[1:], len(g)), keep):
        out[r].extend(g[a : min(e, a + k)].tolist())


def signatures(texts: list[str], frequent: np.ndarray, counts: np.ndarray) -> dict[str, list]:
    """For each text with words its row of the pivot table: which text it is, hashes of its words in order, the number of its
    words, the prefixes and the parities."""
    h, text = codes.words(texts)
    out: dict[str, list] = {c.split()[0]: [] for c in _SIG.split(", ")}
    if not len(h):
        return out
    first = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
    size = np.diff(np.append(first, len(h)))
    rank = np.repeat(np.arange(len(first)), size)
    at = np.minimum(np.searchsorted(frequent, h), len(frequent) - 1)
    often = np.where(frequent[at] == h, counts[at], 1).astype(float)
    with np.errstate(over="ignore"):
        place = (np.arange(len(h)) - first[rank]).astype(np.uint64)
        h1 = np.add.reduceat(codes.mixed(h + place * codes.ODD), first)
        h2 = np.add.reduceat(codes.mixed((h ^ np.uint64(0xA5A5A5A5)) + place * np.uint64(0xD6E8FEB86659FD93)), first)
    token, order = _told_apart(h, rank)
    cell = ((token >> np.uint64(40)) % np.uint64(CELLS)).astype(np.int64)
    owner = rank[order]
    for lo in range(0, len(first), 256):
        a, e = np.searchsorted(owner, [lo, lo + 256])
        many = np.bincount((owner[a:e] - lo) * CELLS + cell[a:e], minlength=min(256, len(first) - lo) * CELLS)
        out["parities"].extend(x.tobytes() for x in np.packbits(many.reshape(-1, CELLS).astype(np.uint8) & 1, axis=1))
    out["prefix"] = [[] for _ in first]
    for width in WIDTHS:
        _first_grams(h, often, rank, first, size, width, out["prefix"])
    out["id"] = text[first].tolist()
    out["h1"], out["h2"], out["n"] = h1.view(np.int64).tolist(), h2.view(np.int64).tolist(), size.tolist()
    return out


def pivot_table(texts: DataFrame, order: DataFrame) -> DataFrame:
    """Of (id, text) the table of pivot distances and prefixes; texts without words are left out. ``order`` has FREQUENT rows
    of 16 bytes at most, which go to all executors."""
    o = order.toPandas().sort_values("word", key=lambda c: c.to_numpy().view(np.uint64))
    sent = texts.sparkSession.sparkContext.broadcast((
        np.append(o["word"].to_numpy().view(np.uint64), np.uint64(2**64 - 1)), np.append(o["n"].to_numpy(), 1)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for part in _chunks(b["text"]):
                rows = pd.DataFrame(signatures(b["text"][part].tolist(), *sent.value))
                yield rows.assign(id=b["id"][part].to_numpy()[rows["id"].to_numpy(dtype=np.int64)])

    return texts.where(F.col("text").isNotNull()).select("id", "text").mapInPandas(run, _SIG)


def _near(x: np.ndarray, y: np.ndarray, least: np.ndarray, n: np.ndarray, parities: np.ndarray) -> np.ndarray:
    """Whether the pivots within the cells leave room for ``least`` common pairs."""
    return np.bitwise_count(parities[x] ^ parities[y]).sum(axis=1, dtype=np.int64) <= n[x] + n[y] - 2 * least


def _meet(key: np.ndarray, ident: np.ndarray, since: int, block: np.ndarray | None = None, parities: np.ndarray | None = None) -> np.ndarray:
    """Pairs of ids (2 x m, the lesser first, distinct) under equal grams, the greater from ``since``, whose distances to the empty
    text leave room for a small one. With ``block`` only pairs of different blocks, with ``parities`` only those that the cells
    leave room for. Rows come sorted by key. Texts of more than N_MOST words meet all of N_MOST."""
    n, key = key & N_MOST, key >> N_BITS
    need = n - missing(n).astype(np.int64)
    top = int(n.max()) + 1 if len(n) else 0
    # the longest text that a text of a length can be a copy of
    lengths = np.arange(top + 1)
    shortest = np.minimum.accumulate((lengths - missing(lengths).astype(np.int64))[::-1])[::-1]
    longest = np.where(lengths * 2 > N_MOST, top, np.minimum(np.searchsorted(shortest, lengths, side="right") - 1, top))
    rank = np.cumsum(np.append(0, key[1:] != key[:-1])) * (top + 1)
    stop = np.searchsorted(rank + n, rank + longest[n], side="right")
    count = np.maximum(stop - np.arange(len(key)) - 1, 0)
    before = np.append(0, np.cumsum(count))
    found = [np.zeros((2, 0), dtype=np.int64)]
    lo = 0
    while lo < len(key):
        hi = max(lo + 1, int(np.searchsorted(before, before[lo] + PAIRS, side="right")) - 1)
        c = count[lo:hi]
        x = np.repeat(np.arange(lo, hi), c)
        y = x + 1 + np.arange(len(x)) - np.repeat(before[lo:hi] - before[lo], c)
        lo = hi
        least = np.maximum(need[x], need[y])
        ok = (np.maximum(ident[x], ident[y]) >= since) & (ident[x] != ident[y])
        if block is not None:
            ok &= block[x] != block[y]
        x, y, least = x[ok], y[ok], least[ok]
        if parities is not None:
            close = _near(x, y, least, n, parities)
            x, y = x[close], y[close]
        found.append(np.unique(np.stack([np.minimum(ident[x], ident[y]), np.maximum(ident[x], ident[y])]), axis=1))
    return np.unique(np.concatenate(found, axis=1), axis=1)


_MET = "a bigint, b bigint, key bigint"


def _runs(since: int):
    """A function over rows (key, id) sorted by key: pairs (a, b) of each gram, or, where a gram has more than RUN rows, the rows
    themselves as (null, id, key)."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("key", pa.int64())])

    def batch(a: np.ndarray | None, b: np.ndarray, key: np.ndarray | None) -> pa.RecordBatch:
        none = pa.nulls(len(b), pa.int64())
        return pa.RecordBatch.from_arrays([none if x is None else pa.array(x) for x in (a, b, key)], schema=schema)

    def settled(key: np.ndarray, ident: np.ndarray) -> Iterator[pa.RecordBatch]:
        gram = key >> N_BITS
        edge = np.flatnonzero(np.append(True, gram[1:] != gram[:-1]))
        size = np.diff(np.append(edge, len(gram)))
        size = np.repeat(size, size)
        big, few = size > RUN, (size > 1) & (size <= RUN)
        if big.any():
            yield batch(None, ident[big], key[big])
        if few.any():
            yield batch(*_meet(key[few], ident[few], since), None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ids = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        for b in batches:
            keys, ids = np.append(keys, b.column(0).to_numpy()), np.append(ids, b.column(1).to_numpy())
            if not len(keys):
                continue
            # the last gram may go on in the next batch; once it is crowded its first RUN + 1 rows are enough to tell
            cut_at = int(np.searchsorted(keys >> N_BITS, keys[-1] >> N_BITS))
            if cut_at:
                yield from settled(keys[:cut_at], ids[:cut_at])
            keys, ids = keys[cut_at:], ids[cut_at:]
            if len(keys) > 2 * RUN + 1:
                yield batch(None, ids[: -RUN - 1], keys[: -RUN - 1])
                keys, ids = keys[-RUN - 1 :], ids[-RUN - 1 :]
        if len(keys):
            yield from settled(keys, ids)

    return run


def _blocks(since: int):
    """A function over two blocks of a crowded gram, or one with itself, that gives their pairs."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("key", kind="stable")
        within = rows["one"].iloc[0] == rows["other"].iloc[0]
        parities = np.frombuffer(b"".join(rows["parities"]), dtype=np.uint64).reshape(len(rows), -1)
        a, b = _meet(rows["key"].to_numpy(), rows["id"].to_numpy(), since, None if within else rows["block"].to_numpy(), parities)
        return pd.DataFrame({"a": a, "b": b})

    return run


def keys_of(table: DataFrame) -> DataFrame:
    return table.select(F.explode("prefix").alias("key"), "id")


def candidate_pairs(pivots: DataFrame, keys: DataFrame, since: int | None = None) -> DataFrame:
    """(a, b) with a < b of all texts, b from ``since``, whose prefixes (key, id) and pivot distances (id, n, parities) leave room
    for a small distance. A gram of many texts is compared with the cells at hand, so that only near pairs leave its task, and
    one of more than BLOCK texts is split into blocks, of which every two meet in a task of their own."""
    since = -(2**63) if since is None else since
    met = cut(keys.repartition(F.shiftright("key", N_BITS)).sortWithinPartitions("key").mapInArrow(_runs(since), _MET))
    pairs = met.where("a is not null").select("a", "b")
    crowd = met.where("a is null").select("key", F.col("b").alias("id"), F.shiftright("key", N_BITS).alias("gram"))
    n_crowd = crowd.count()
    if n_crowd:
        sizes = crowd.groupBy("gram").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
        c = crowd.join(sizes, "gram").withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
        # grams that need no blocks go together in groups of about BLOCK rows
        c = c.withColumn("whole", F.col("blocks") == 1).withColumn("group", F.when(F.col("whole"), F.pmod("gram", F.lit(n_crowd // BLOCK + 1))).otherwise(F.col("gram")))
        c = c.join(pivots.select("id", "parities"), "id").withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        c = c.withColumn("one", F.least("block", "with")).withColumn("other", F.greatest("block", "with")).drop("with", "blocks", "gram")
        pairs = pairs.unionByName(c.groupBy("whole", "group", "one", "other").applyInPandas(_blocks(since), "a bigint, b bigint"))
    # near pairs are few, so both joins are small on one side
    p = pairs.distinct().join(pivots.toDF("a", "na", "pa"), "a").join(pivots.toDF("b", "nb", "pb"), "b")

    @F.pandas_udf("boolean")
    def near(na: pd.Series, pa_: pd.Series, nb: pd.Series, pb: pd.Series) -> pd.Series:
        n = np.concatenate([na.to_numpy(), nb.to_numpy()]).astype(np.int64)
        need = n - missing(n).astype(np.int64)
        wide = np.frombuffer(b"".join([*pa_, *pb]), dtype=np.uint64).reshape(len(n), -1)
        x, y = np.arange(len(na)), np.arange(len(na)) + len(na)
        return pd.Series(_near(x, y, np.maximum(need[x], need[y]), n, wide))

    return p.where(near("na", "pa", "nb", "pb")).select("a", "b")


def _few(ids: DataFrame) -> DataFrame:
    """``ids``, sent to all executors where there are SHIP_IDS at most."""
    return F.broadcast(ids) if fits(ids, SHIP_IDS) else ids


def _salted(left: DataFrame, right: DataFrame, on: list[str], by: str) -> DataFrame:
    """Inner join in which the rows of one key on the left are spread over SALT tasks."""
    r = right.withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(SALT)])))
    return left.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(SALT)).cast("int")).join(r, [*on, "_salt"]).drop("_salt")


def verified(pairs: DataFrame, texts: list[DataFrame]) -> DataFrame:
    """The pairs whose texts are the same by the true distance. ``texts`` are (id, text) or (id, text, folder) tables; of one
    with folders only those are read that hold a text in question."""
    ids = cut(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct().withColumn("folder", F.shiftright("id", FOLDER_BITS)))
    small = _few(ids)
    parts = [t.join(small, ["id", "folder"] if "folder" in t.columns else "id", "left_semi").select("id", "text") for t in texts]
    needed = parts[0]
    for p in parts[1:]:
        needed = needed.unionByName(p)
    needed = cut(needed)

    @F.pandas_udf("boolean")
    def same(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([same_text(x, y) for x, y in zip(a, b)], dtype=bool)

    left = pairs.join(needed.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
    return left.join(needed.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b").where(same("ta", "tb")).select("a", "b")


def accepted_of(links: DataFrame, since: int | None = None) -> DataFrame:
    """(id, root) of each text that repeats an accepted one, from (a, b) links with a < b. In order of ids a text is
    accepted unless it links to an accepted text before it; ids under ``since`` are accepted from the start. A round settles every
    text that links to an accepted one, or whose links all lead to settled ones; the least open text always is among them.
    Near-copies form shallow stars, so there are few rounds."""
    links = cut(links)
    if links.isEmpty():
        return links.select(F.col("b").alias("id"), F.col("a").alias("root"))
    heads = links.select(F.col("a").alias("id")).distinct().join(links.select(F.col("b").alias("id")), "id", "left_anti")
    states = heads.union(links.where(F.col("a") < since).select("a").distinct()).distinct() if since is not None else heads
    states = states.withColumn("accepted", F.lit(True))
    states = cut(states)
    while True:
        open_ = links.join(states.select(F.col("id").alias("b")), "b", "left_anti").join(states.select(F.col("id").alias("a"), "accepted"), "a", "left")
        texts = open_.groupBy(F.col("b").alias("id")).agg(F.coalesce(F.max("accepted"), F.lit(False)).alias("copy"), F.count_if(F.col("accepted").isNull()).alias("open"))
        new = cut(texts.where("copy or open = 0").select("id", (~F.col("copy")).alias("accepted")))
        if new.isEmpty():
            break
        states = cut(states.union(new))
    copies = states.where("not accepted").select(F.col("id").alias("b"))
    good = states.where("accepted").select(F.col("id").alias("a"))
    return links.join(copies, "b", "left_semi").join(good, "a", "left_semi").groupBy(F.col("b").alias("id")).agg(F.min("a").alias("root"))


def _matched(new: DataFrame, texts: list[DataFrame], old: DataFrame | None = None, since: int | None = None) -> DataFrame:
    """(result_id_a, result_id_b): b of the pivot table ``new`` repeats the accepted text a, of ``new`` or of ``old``, all of
    whose texts are accepted and have ids under ``since``. Exact copies are first reduced to their first text, so a group of
    copies of any size costs one row."""
    ids = new.select("id", "h1", "h2", "n")
    every = ids if old is None else ids.unionByName(old.select("id", "h1", "h2", "n"))
    first = every.groupBy("h1", "h2", "n").agg(F.min("id").alias("first"), F.count("*").alias("c")).where("c > 1").drop("c")
    copies = cut(_salted(ids, first, ["h1", "h2", "n"], "id").where("id <> first").select("id", "first"))
    single = new.join(_few(copies.select("id")), "id", "left_anti")
    pivots, keys = new.select("id", "n", "parities"), keys_of(single)
    if old is not None:
        pivots = pivots.unionByName(old.select("id", "n", "parities"))
        keys = keys.unionByName(hits(old, keys))
    pairs = cut(candidate_pairs(pivots, keys, since))
    roots = accepted_of(verified(pairs, texts), since)
    exact = copies.join(roots.select(F.col("id").alias("first"), "root"), "first", "left").select(F.coalesce("root", "first").alias("result_id_a"), F.col("id").alias("result_id_b"))
    return exact.union(roots.select(F.col("root").alias("result_id_a"), F.col("id").alias("result_id_b")))


def hits(old: DataFrame, keys: DataFrame) -> DataFrame:
    """The (key, id) of the history whose gram may be among ``keys``, of which a bitmap of fixed size (2^BITS bits) goes to the
    executors. The history is scanned but not shuffled; a full bitmap lets more through and loses nothing."""
    place = F.shiftright("key", N_BITS).bitwiseAND((1 << BITS) - 1) + 1
    chunks = keys.select(place.alias("v")).groupBy(F.bitmap_bucket_number("v").alias("c")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("v")).alias("bits")).collect()
    bitmap = np.zeros((1 << BITS) // 8, dtype=np.uint8)
    for r in chunks:
        at = (r["c"] - 1) * 4096
        bitmap[at : at + 4096] = np.frombuffer(r["bits"], dtype=np.uint8)
    sent = old.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(1)
            key = lists.flatten().to_numpy()
            ident = np.repeat(b.column(0).to_numpy(), np.diff(lists.offsets.to_numpy()))
            at = (key >> N_BITS) & ((1 << BITS) - 1)
            there = (sent.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
            yield pa.RecordBatch.from_arrays([pa.array(key[there]), pa.array(ident[there])], names=["key", "id"])

    return old.select("id", "prefix").mapInArrow(run, "key bigint, id bigint")


def repeats(texts: DataFrame) -> DataFrame:
    """(result_id_a, result_id_b): b repeats the accepted text a, a < b. ``texts`` holds (id, text), ids unique and in order
    of arrival. Null texts and texts without words repeat nothing."""
    return _matched(cut(pivot_table(texts, word_order(texts))), [texts.select("id", "text")])


class History:
    """All accepted texts and the pivot table in a folder, to which each batch appends. The order of words is fixed by the
    first batch and kept beside them. Texts lie in folders by ranges of ids, and only folders with a candidate are read."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def read(self, name: str) -> DataFrame | None:
        """The table ``order``, ``pivots`` (of all texts), ``copies`` (id, root) or ``texts``; None before the first batch."""
        try:
            return self.spark.read.parquet(f"{self.path}/{name}")
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None

    def order(self, batch: DataFrame) -> DataFrame:
        if self.read("order") is None:
            word_order(batch).write.parquet(f"{self.path}/order")
        return self.read("order")

    def add(self, batch: DataFrame, number: int) -> DataFrame:
        """Matches batch ``number`` of (id, text), ids greater than all before, appends its rows and gives its
        (result_id_a, result_id_b). Each text is worked on once, when it comes; afterwards only its row of the pivot table and
        the texts of candidates are read."""
        batch = batch.where(F.col("text").isNotNull() & F.col("id").isNotNull()).select("id", "text")
        old, copies, texts = self.read("pivots"), self.read("copies"), self.read("texts")
        folder = f"{self.path}/pivots/part={number}"
        pivot_table(batch, self.order(batch)).write.parquet(folder)
        new = self.spark.read.parquet(folder)
        if old is not None:
            old = old.drop("part").join(_few(copies.select("id")), "id", "left_anti")
        since = new.agg(F.min("id")).first()[0]
        if since is None:
            return new.select(F.col("id").alias("result_id_a"), F.col("id").alias("result_id_b"))
        matched = _matched(new, [batch] + ([texts] if texts is not None else []), old, since)
        matched.select(F.col("result_id_b").alias("id"), F.col("result_id_a").alias("root")).write.parquet(f"{self.path}/copies/part={number}")
        found = self.spark.read.parquet(f"{self.path}/copies/part={number}")
        fresh = batch.join(_few(found.select("id")), "id", "left_anti").withColumn("folder", F.shiftright("id", FOLDER_BITS))
        fresh.write.mode("append").partitionBy("folder").parquet(f"{self.path}/texts")
        return found.select(F.col("root").alias("result_id_a"), F.col("id").alias("result_id_b"))


def batches(rows: DataFrame, spark: SparkSession, path: str) -> DataFrame:
    """``repeats`` of (id, text, batch), batch after batch through a ``History`` in ``path``. Batches are ranges of ids: one
    begins with its least id, so a row without a batch number belongs to the batch it arrived with. There are as many batches
    as arrivals; their first ids reach the driver."""
    starts = sorted(r["s"] for r in rows.where(F.col("batch").isNotNull() & F.col("id").isNotNull()).groupBy("batch").agg(F.min("id").alias("s")).collect()) or [0]
    h, out = History(spark, path), None
    for k, start in enumerate(starts):
        low = F.col("id") >= start if k else F.lit(True)
        matched = h.add(rows.where(low & (F.col("id") < starts[k + 1]) if k + 1 < len(starts) else low), k)
        out = matched if out is None else out.unionByName(matched)
    return out
