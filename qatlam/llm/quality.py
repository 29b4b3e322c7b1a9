"""Per-document text statistics and what they say about natural prose (problem 1).

The characters of many texts are counted in one vectorised pass: every code point is looked up in a table of classes, and
sums over the classes, over words and over lines give the counts of each text. As built-in expressions the same counts
take a dozen regular expressions a text and several times the work. The robust centre and spread of prose are estimated
per profile (language, script and size class) over all rows: median and MAD first, then mean and covariance of the rows
near them; only these few numbers reach the driver. A row's squared Mahalanobis distance is the sum of its statistics'
contributions ``z_i * (P z)_i``. The distance alone decides whether a row is an outlier, and the contributions alone what
kind of outlier it is.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from qatlam.runtime import cut

#: Statistics that enter the distance, and the spread that each has in prose at least. A statistic that hardly varies in a
#: corpus (bullets, columns) would decide alone without it.
STATS = {
    "log_line_words": 0.9, "mean_word_length": 0.8, "symbol_ratio": 0.01, "digit_ratio": 0.03, "end_punct_share": 0.6, "common_word_share": 0.1,
    "log_distinct": 0.05, "log_columns": 0.2, "vowel_ratio": 0.03, "log_comma_run": 0.07, "log_fused": 0.15, "cluster_rate": 0.04, "log_items": 0.14,
}
#: What a contribution speaks for where the statistic lies on the given side of its mean.
SPEAKS = {
    "table": {"log_columns": 1}, "list": {"log_items": 1},
    "junk": {"symbol_ratio": 1, "log_distinct": -1, "log_comma_run": 1, "log_fused": 1, "cluster_rate": 1, "vowel_ratio": -1},
}
LANGUAGES = ["uz", "ru", "en", "tr", "kk"]
#: A profile's numbers are drawn towards those of all rows as if it had so many more rows that are like them.
PRIOR_ROWS = 2000
#: Bound on the distance per statistic above which a record is an outlier.
OUTLIER = 2.5
#: Texts are counted together up to so many characters.
CHUNK = 200_000

COUNTS = ["n_chars", "n_words", "n_distinct", "n_letters", "n_digits", "n_symbols", "n_commas", "n_stops", "n_vowels", "n_lines", "n_ends", "n_columns", "n_items", "n_fused", "n_clusters"]

LETTER, SPACE, DIGIT, PLAIN, COMMA, STOP, VOWEL, APOSTROPHE, CONSONANT, CYRILLIC, END, COLUMN, BULLET = (1 << i for i in range(13))
_SIZE = 1 << 16
_SIGNS = {
    PLAIN: ".,!?…:;()\"'«»“”„‘’ʻʼ`–—-|·/", COMMA: ",", STOP: ".!?…", VOWEL: "aeiouаеёиоуўэюяыөәүұіöüıâîAEIOUАЕЁИОУЎЭЮЯЫӨӘҮҰІÖÜIÂÎ", APOSTROPHE: "'’‘ʻʼ`",
    CONSONANT: "bcdfghjklmnpqrstvwxzBCDFGHJKLMNPQRSTVWXZ", END: ".!?…:;»”\"", COLUMN: "\t|;·", BULLET: "-–—•*▪●◦‣+",
}
_NL, _BLANK, _TAB, _DOT, _OPEN, _CLOSE, _SEMICOLON = map(ord, "\n \t.();")


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each code point its classes and lower case, and the powers that make hashes of words."""
    classes, lower = np.zeros(_SIZE, dtype=np.uint16), np.arange(_SIZE, dtype=np.uint64)
    for i in range(_SIZE):
        c = chr(i)
        category = unicodedata.category(c)
        if category[0] == "L":
            classes[i] |= LETTER
            if len(c.lower()) == 1:
                lower[i] = ord(c.lower())
        classes[i] |= SPACE * c.isspace() | DIGIT * (category == "Nd") | CYRILLIC * (0x400 <= i <= 0x4FF)
    for bit, signs in _SIGNS.items():
        classes[[ord(c) for c in signs]] |= bit
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, dtype=np.uint64))
    return classes, lower, powers


def _mixed(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return h ^ (h >> np.uint64(29))


def word_hashes(words: list[str]) -> np.ndarray:
    """Hashes of words as ``count`` makes them, sorted."""
    _, lower, powers = _tables()
    out = []
    with np.errstate(over="ignore"):
        for w in words:
            c = lower[[min(ord(x), _SIZE - 1) for x in w]]
            out.append((c * powers[np.arange(len(c)) & 63]).sum(dtype=np.uint64))
    return np.sort(_mixed(np.array(out, dtype=np.uint64)))


def count(texts: list[str], common: dict[str, np.ndarray]) -> pd.DataFrame:
    """The counts of each text, one row each: COUNTS, Cyrillic letters and the distinct common words of each language."""
    classes, lower, powers = _tables()
    n = len(texts)
    cp = np.minimum(np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), dtype=np.uint32), _SIZE - 1)
    size = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=n)
    start = np.cumsum(size) - size
    b = classes[cp]

    def has(bits: int) -> np.ndarray:
        return (b & bits) != 0

    def total(mask: np.ndarray) -> np.ndarray:
        return np.add.reduceat(mask, start, dtype=np.int64)

    def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        step = np.diff(mask.astype(np.int8), prepend=0, append=0)
        return np.flatnonzero(step == 1), np.flatnonzero(step == -1)

    def per_text(at: np.ndarray) -> np.ndarray:
        return np.bincount(np.searchsorted(start, at, side="right") - 1, minlength=n)

    letter, space, digit = has(LETTER), has(SPACE), has(DIGIT)
    out = {"n_chars": size - total(space), "n_letters": total(letter), "n_digits": total(digit), "n_commas": total(has(COMMA)), "n_vowels": total(has(VOWEL)), "n_cyrillic": total(has(CYRILLIC))}
    # stops within numbers and dates end nothing
    stops = total(has(STOP) & ~np.append((letter | digit)[1:], False))

    # words: their hashes are sums of products, so all words' are made at once
    inside = has(LETTER | APOSTROPHE)
    first, end = runs(inside)
    length = end - first
    at = np.flatnonzero(inside)
    with np.errstate(over="ignore"):
        product = lower[cp[at]] * powers[(at - np.repeat(first, length)) & 63]
        h = _mixed(np.add.reduceat(product, np.cumsum(length) - length)) if len(first) else np.zeros(0, dtype=np.uint64)
    text = np.searchsorted(start, first, side="right") - 1
    out["n_words"] = np.bincount(text, minlength=n)
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    h, text = h[new], text[new]
    out["n_distinct"] = np.bincount(text, minlength=n)
    for lang, known in common.items():
        out[f"common_{lang}"] = np.bincount(text[np.isin(h, known)], minlength=n)

    # lines that are not blank, from their first to their last sign
    line_end = np.flatnonzero(cp == _NL)
    dark = np.flatnonzero(~space)
    left, right = np.searchsorted(dark, np.concatenate(([0], line_end[:-1] + 1))), np.searchsorted(dark, line_end) - 1
    filled = left <= right
    left, right = dark[left[filled]], dark[right[filled]]
    out["n_lines"], out["n_ends"] = per_text(left), per_text(left[(b[right] & END) != 0])
    # bullets and item numbers at the start of lines
    more, codes = np.append(b, np.full(8, SPACE, dtype=b.dtype)), np.append(cp, np.full(8, _NL, dtype=cp.dtype))
    blank = lambda i: (codes[i] == _BLANK) | (codes[i] == _TAB)
    sign = ((more[left] & BULLET) != 0) & ((more[left] & PLAIN) == 0) & blank(left + 1)
    j = left + (codes[left] == _OPEN)
    k = j
    for _ in range(3):
        k = k + ((more[k] & DIGIT) != 0)
    k = np.where(k == j, j + ((more[j] & LETTER) != 0), k)
    dotted = (k > j) & (codes[k] == _DOT) & blank(k + 1)
    out["n_stops"] = np.maximum(stops - per_text(left[dotted]), 0)
    out["n_symbols"] = total(~has(LETTER | SPACE | DIGIT | PLAIN)) - per_text(left[sign])
    # columns: separators, but for a semicolon at the line's end, and gaps of three spaces
    column = has(COLUMN)
    column[right] &= cp[right] != _SEMICOLON
    gap = cp == _BLANK
    cells = np.concatenate([np.flatnonzero(column), runs(gap[2:] & gap[1:-1] & gap[:-2])[0]])
    out["n_columns"] = per_text(cells)
    celled = np.zeros(len(line_end), dtype=bool)
    celled[np.searchsorted(line_end, cells)] = True
    out["n_items"] = per_text(left[~celled[filled]])
    out["n_fused"] = per_text(np.flatnonzero((letter[1:] & digit[:-1]) | (digit[1:] & letter[:-1])))
    a, z = runs(has(CONSONANT))
    out["n_clusters"] = per_text(np.repeat(a, (z - a) // 5))
    return pd.DataFrame(out)


def derived(c: pd.DataFrame, langs: list[str]) -> pd.DataFrame:
    """The statistics of STATS and the profile from the counts. ``n_items`` are the lines without columns."""
    words, lines, chars = c["n_words"].clip(lower=1), c["n_lines"].clip(lower=1), c["n_chars"].clip(lower=1)
    hits = c[[f"common_{k}" for k in langs]].to_numpy() if langs else np.zeros((len(c), 1), dtype=np.int64)
    most = hits.max(axis=1) if len(c) else np.zeros(0)
    lang = np.where(most > 0, np.array(langs or ["uz"])[hits.argmax(axis=1)], "uz") if len(c) else np.zeros(0, dtype=str)
    script = np.where(c["n_cyrillic"] * 2 > c["n_letters"], "cyrl", "latn")
    length = np.where(c["n_words"] < 25, "short", np.where(c["n_words"] < 120, "medium", "long"))
    out = c[COUNTS].copy()
    out["profile"] = [f"{a}-{b}-{s}" for a, b, s in zip(lang, script, length)]
    out["log_line_words"] = np.log1p(c["n_words"] / lines)
    out["mean_word_length"] = (c["n_letters"] + 14) / (c["n_words"] + 2)
    out["symbol_ratio"] = c["n_symbols"] / chars
    out["digit_ratio"] = c["n_digits"] / chars
    out["end_punct_share"] = c["n_ends"] / lines
    out["common_word_share"] = most / c["n_distinct"].clip(lower=1)
    out["log_distinct"] = (1 + np.log1p(c["n_distinct"])) / (1 + np.log1p(c["n_words"]))
    out["log_columns"] = np.log1p(10 * c["n_columns"] * (1 - 1 / lines) / words)
    out["vowel_ratio"] = (c["n_vowels"] + 4) / (c["n_letters"] + 10)
    out["log_comma_run"] = np.log1p(c["n_commas"] ** 2 / (words * (c["n_stops"] + lines)))
    out["log_fused"] = np.log1p(10 * c["n_fused"] / words)
    out["cluster_rate"] = c["n_clusters"] / words
    out["log_items"] = np.log1p(c["n_items"] ** 2 / (words * (c["n_stops"] + 1)))
    return out


def _chunks(texts: list[str | None]) -> Iterator[list[int]]:
    """Positions of the texts with a sign in them, together of CHUNK characters or one longer text."""
    rows: list[int] = []
    size = 0
    for i, t in enumerate(texts):
        if t and not t.isspace():
            if rows and size + len(t) > CHUNK:
                yield rows
                rows, size = [], 0
            rows.append(i)
            size += len(t)
    if rows:
        yield rows


def statistics(texts: DataFrame, common: DataFrame, text: str = "text") -> DataFrame:
    """``texts`` without its text column plus the counts, the profile and one column per statistic. ``common`` holds (lang,
    word) and is a fixed list of a few hundred words; one-letter words, which also number list items, are left out. Null and
    blank texts have null statistics; a text without letters has zero for all that is a share of letters or words. Columns of
    ``texts`` must not be named as the statistics are."""
    lists = {r["lang"]: word_hashes(r["words"]) for r in common.where("length(word) > 1").groupBy("lang").agg(F.collect_set(F.lower("word")).alias("words")).collect()}
    langs = [k for k in LANGUAGES if k in lists]
    known = {k: lists[k] for k in langs}
    kept = [f for f in texts.schema.fields if f.name != text]
    added = [*[StructField(c, LongType()) for c in COUNTS], StructField("profile", StringType()), *[StructField(c, DoubleType()) for c in STATS]]
    types = [pa.int64()] * len(COUNTS) + [pa.string()] + [pa.float64()] * len(STATS)
    names = [f.name for f in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ts = b.column(len(kept)).to_pylist()
            parts = [(rows, derived(count([ts[i] for i in rows], known), langs)) for rows in _chunks(ts)]
            if parts:
                frame = pd.concat([p.set_axis(rows) for rows, p in parts]).reindex(range(len(ts)))[names]
                new = [pa.array(frame[c], type=t, from_pandas=True) for c, t in zip(names, types)]
            else:
                new = [pa.nulls(len(ts), t) for t in types]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(kept)], *new], names=[*[f.name for f in kept], *names])

    return texts.select(*[f.name for f in kept], text).mapInArrow(run, StructType([*kept, *added]))


Model = dict[str, tuple[np.ndarray, np.ndarray]]


def prose_model(stats: DataFrame) -> Model:
    """Robust mean and precision matrix of each profile, and under "" of all rows. ``stats`` is read three times and
    aggregated to some hundred numbers per profile; the numbers of small profiles are drawn towards those of all rows."""
    names, floor = list(STATS), np.array(list(STATS.values()))
    k = len(names)
    rows = stats.where(F.col("n_chars").isNotNull()).select("profile", *names)

    def by_profile(df: DataFrame, aggs: list[Column], shape: int) -> dict[str, np.ndarray]:
        got = {r["profile"]: (r["n"], np.array(list(r)[-shape:], dtype=float)) for r in df.groupBy("profile").agg(F.count("*").alias("n"), *aggs).collect()}
        if not got:
            return {}
        # all rows together: the mean over the profiles by their rows, which for moments is exact
        whole = sum(n * v for n, v in got.values()) / sum(n for n, _ in got.values())
        return {p: (n * v + PRIOR_ROWS * whole) / (n + PRIOR_ROWS) for p, (n, v) in got.items()} | {"": whole}

    def beside(by: dict[str, np.ndarray], name: str, df: DataFrame) -> DataFrame:
        small = df.sparkSession.createDataFrame([(p, [float(x) for x in v]) for p, v in by.items()], f"profile string, {name} array<double>")
        return df.join(F.broadcast(small), "profile")

    middle = by_profile(rows, [F.percentile_approx(x, 0.5, 1000) for x in names], k)
    if not middle:
        return {}
    rows = beside(middle, "_mid", rows)
    off = [F.abs(F.col(x) - F.get("_mid", F.lit(i))) for i, x in enumerate(names)]
    mad = {p: np.maximum(1.4826 * v, floor) for p, v in by_profile(rows, [F.percentile_approx(o, 0.5, 1000) for o in off], k).items()}
    near = F.forall(F.zip_with(F.array(*off), "_mad", lambda o, m: o <= 5 * m), lambda x: x)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    moments = [F.avg(x) for x in names] + [F.avg(F.col(names[i]) * F.col(names[j])) for i, j in pairs]
    model: Model = {}
    for p, v in by_profile(beside(mad, "_mad", rows).where(near), moments, k + len(pairs)).items():
        mean, cov = v[:k], np.zeros((k, k))
        for (i, j), x in zip(pairs, v[k:]):
            cov[i, j] = cov[j, i] = x - mean[i] * mean[j]
        model[p] = (mean, np.linalg.inv(cov + np.diag(floor**2)))
    return model


def scored(stats: DataFrame, model: Model) -> DataFrame:
    """``stats`` with ``distance`` (squared, per statistic), ``contributions`` (an array in the order of STATS) and ``kind``:
    of an outlier ``table``, ``list`` or ``junk``, whichever the contributions speak for most, null for prose."""
    names, kinds = list(STATS), list(SPEAKS)
    sides = np.array([[SPEAKS[g].get(x, 0) for x in names] for g in kinds])
    fields = [*stats.schema.fields, StructField("contributions", ArrayType(DoubleType())), StructField("distance", DoubleType()), StructField("kind", StringType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.stack([b.column(c).to_numpy(zero_copy_only=False).astype(float) for c in names], axis=1)
            profile = b.column("profile").to_pylist()
            share = np.full(x.shape, np.nan)
            offset = np.zeros(x.shape)
            groups: dict[str, list[int]] = {}
            for i, p in enumerate(profile):
                if p is not None and model:
                    groups.setdefault(p if p in model else "", []).append(i)
            for p, at in groups.items():
                mean, precision = model[p]
                offset[at] = x[at] - mean
                share[at] = offset[at] * (offset[at] @ precision)
            distance = share.sum(axis=1) / len(names)
            for_kind = np.stack([np.where(np.sign(offset) * s > 0, np.maximum(share, 0), 0).sum(axis=1) for s in sides], axis=1)
            best = np.where(distance > OUTLIER, for_kind.argmax(axis=1), -1)
            given = [p is not None and bool(model) for p in profile]
            new = [
                pa.array([r.tolist() if g else None for r, g in zip(share, given)], type=pa.list_(pa.float64())),
                pa.array([float(d) if g else None for d, g in zip(distance, given)], type=pa.float64()),
                pa.array([kinds[k] if k >= 0 else None for k in best], type=pa.string()),
            ]
            yield pa.RecordBatch.from_arrays([*b.columns, *new], names=[f.name for f in fields])

    return stats.mapInArrow(run, StructType(fields))


def text_quality(texts: DataFrame, common: DataFrame, text: str = "text") -> DataFrame:
    """Counts, statistics, distance, contributions and ``kind`` (null for prose) of every row; ``texts`` keeps its other
    columns. Null and blank texts have nulls throughout; equal texts have equal results; an empty table gives an empty one."""
    stats = cut(statistics(texts, common, text))
    return scored(stats, prose_model(stats))


def records(results: DataFrame, blocks: DataFrame) -> DataFrame:
    """Both tables' texts as (record, record_id, text)."""
    a = results.select(F.lit("results").alias("record"), F.col("result_id").alias("record_id"), F.col("kept_text").alias("text"))
    b = blocks.select(F.lit("blocks").alias("record"), F.col("block_id").alias("record_id"), "text")
    return a.unionByName(b)
