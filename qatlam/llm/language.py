"""Language of each block and of each sentence in it (problem 6).

Multinomial logistic regression on TF-IDF weighted character 2- and 3-grams, trained with follow-the-regularised-leader
(per-coordinate rates, elastic net) on a bounded sample of labelled blocks and calibrated with a temperature on held-out
sentences. The model is one small table, so all blocks are scored in a single vectorised pass without a shuffle; only then
are they joined with the labels they came with.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qatlam.llm.quality import prose_model, scored, statistics
from qatlam.runtime import cut

LANGS = ["uz", "ru", "en", "tr", "kk"]
#: Size of the hashed n-gram table.
BUCKETS = 1 << 16
#: Bound of the training sample: labelled blocks, and sentences of them.
TRAIN_BLOCKS = 5000
TRAIN_SENTENCES = 9000
#: A sentence counts for its language when it has so many words and letters, and the model is so sure.
LEAST_WORDS, LEAST_LETTERS, SURE = 4, 18, 0.60

#: Other spellings of the language codes.
ALIASES = {"uzb": "uz", "uzn": "uz", "uzbek": "uz", "rus": "ru", "russian": "ru", "eng": "en", "english": "en", "tur": "tr", "turkish": "tr", "kaz": "kk", "kazakh": "kk"}
UNUSABLE = ["", "und", "unknown", "unk", "none", "null", "n/a", "mul", "zxx", "mis"]

_SENTENCE = re.compile(r"(?<=[.!?…])[»”\"’)]*\s+|\n+")
_WORD = re.compile(r"[^\W\d_]+")
_SPACE = ord(" ")
#: Signs and digits of ASCII and the no-break space are spaces; letters beyond ASCII and the apostrophe stay.
_PLAIN = np.arange(1 << 16, dtype=np.uint16)
_PLAIN[[i for i in range(128) if not (chr(i).isalpha() or i == 39)] + [160]] = _SPACE


def label_code(label: Column) -> Column:
    """A label in one spelling; null where it names no language."""
    x = F.regexp_replace(F.lower(F.trim(label)), r"^__label__", "")
    x = F.trim(F.regexp_replace(x, r"[-_].*$", ""))
    x = F.when(x.isin(UNUSABLE), None).otherwise(x)
    return F.coalesce(*[F.when(x == a, c) for a, c in ALIASES.items()], x)


def sentences(text: str) -> list[str]:
    return [s for s in _SENTENCE.split(text) if s and s.strip()]


def grams(parts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For n of 2 and 3 the hashed n-grams of all parts and the number of the part of each. Letters are taken modulo 2^16,
    which covers all scripts in use here."""
    c = np.frombuffer("\n".join([" " + p + " " for p in parts]).lower().encode("utf-16-le", "replace"), dtype=np.uint16)
    part = np.cumsum(c == 10, dtype=np.int32)
    c = _PLAIN[c]
    with np.errstate(over="ignore"):
        a = c.astype(np.uint32) * np.uint32(0x9E3779B1)
        h2 = (a[:-1] ^ (a[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA77) + a[1:]
        h3 = (h2[:-1] ^ (h2[:-1] >> np.uint32(13))) * np.uint32(0xC2B2AE3D) + a[2:]
    word = c != _SPACE
    keep2, keep3 = np.flatnonzero(word[:-1] | word[1:]), np.flatnonzero(word[1:-1])
    top = np.uint32(16)
    return (
        [((h2[keep2] * np.uint32(0x27D4EB2F)) >> top).astype(np.int32), ((h3[keep3] * np.uint32(0x27D4EB2F)) >> top).astype(np.int32)],
        [part[:-1][keep2], part[1:-1][keep3]],
    )


class Model:
    """``table``: per n-gram the weight of each language times its IDF, then the squared IDF."""

    def __init__(self, table: np.ndarray, bias: np.ndarray, temperature: float):
        self.table, self.bias, self.temperature = table, bias, temperature

    def logits(self, parts: list[str]) -> np.ndarray:
        n = len(parts)
        total = np.zeros((n, self.table.shape[1]))
        for ids, part in zip(*grams(parts)):
            if len(ids):
                starts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
                total[part[starts]] += np.add.reduceat(self.table[ids], starts, axis=0)
        norm = np.sqrt(np.maximum(total[:, -1:], 1e-9))
        return total[:, :-1] / norm + self.bias

    def probabilities(self, parts: list[str]) -> np.ndarray:
        z = self.logits(parts) / self.temperature
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def _samples(parts: list[str], idf: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    ids = [np.zeros(0, dtype=np.int32)] * len(parts)
    for g, part in zip(*grams(parts)):
        cuts = np.searchsorted(part, np.arange(1, len(parts)))
        ids = [np.concatenate((a, b)) for a, b in zip(ids, np.split(g, cuts))]
    out = []
    for g in ids:
        f, n = np.unique(g, return_counts=True)
        v = n * idf[f]
        out.append((f, v / np.sqrt(max(1e-9, (n * idf[f] ** 2).sum()))))
    return out


def train(parts: list[str], labels: np.ndarray, epochs: int = 2, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.5, seed: int = 7) -> Model:
    """FTRL-proximal over the sentences, in a fixed shuffled order; a tenth of them sets the temperature. The labels are
    noisy, but most texts of each language carry its label: a first model is trained on them as they are, and the second
    on the labels of which the first is sure."""
    rng = np.random.default_rng(seed)
    df = np.zeros(BUCKETS)
    for g, part in zip(*grams(parts)):
        u = np.unique(part.astype(np.int64) * BUCKETS + g)
        df += np.bincount(u % BUCKETS, minlength=BUCKETS)
    idf = np.log((1 + len(parts)) / (1 + df)) + 1
    data = _samples(parts, idf)
    order = rng.permutation(len(parts))
    held, rest = order[: len(order) // 10], order[len(order) // 10 :]
    k = len(LANGS)

    def fit(rows: np.ndarray) -> Model:
        z, n = np.zeros((BUCKETS + 1, k)), np.zeros((BUCKETS + 1, k))

        def weights(f: np.ndarray) -> np.ndarray:
            zf = z[f]
            return np.where(np.abs(zf) <= l1, 0.0, -(zf - np.sign(zf) * l1) / ((beta + np.sqrt(n[f])) / alpha + l2))

        for _ in range(epochs):
            for i in rng.permutation(rows):
                f, v = data[i]
                f, v = np.append(f, BUCKETS), np.append(v, 1.0)
                w = weights(f)
                s = v @ w
                p = np.exp(s - s.max())
                p /= p.sum()
                p[labels[i]] -= 1
                g = np.outer(v, p)
                g2 = g * g
                z[f] += g - (np.sqrt(n[f] + g2) - np.sqrt(n[f])) / alpha * w
                n[f] += g2
        w = weights(np.arange(BUCKETS + 1))
        return Model(np.concatenate([w[:-1] * idf[:, None], idf[:, None] ** 2], axis=1).astype(np.float32), w[-1], 1.0)

    first = fit(rest)
    p = first.probabilities(parts)
    noisy, labels, clear = labels, p.argmax(axis=1), p.max(axis=1) > 0.6
    model = fit(rest[clear[rest]])
    if len(held):
        z, y = model.logits([parts[i] for i in held]), noisy[held]

        def loss(t: float, noise: float) -> float:
            """Of the labels as given, if a share of them is drawn at random."""
            s = z / t
            e = np.exp(s - s.max(axis=1, keepdims=True))
            q = (e / e.sum(axis=1, keepdims=True))[np.arange(len(y)), y]
            return float(-np.log((1 - noise) * q + noise / k).mean())

        grid = [(float(t), float(r)) for t in np.geomspace(0.25, 3, 24) for r in np.linspace(0.005, 0.4, 24)]
        model.temperature = min(grid, key=lambda x: loss(*x))[0]
    return model


def latest(results: DataFrame) -> DataFrame:
    """(block_id, is_uzbek, label): the row scored last of each block; rows without a time come first."""
    r = results.select("block_id", F.struct(F.coalesce("scored_at", F.lit("0001-01-01").cast("timestamp")).alias("t"), F.coalesce("fasttext_confidence", F.lit(-1.0)).alias("c"), "fasttext_label", "is_uzbek").alias("r"))
    r = r.groupBy("block_id").agg(F.max("r").alias("r"))
    return r.select("block_id", F.col("r.is_uzbek").alias("is_uzbek"), label_code(F.col("r.fasttext_label")).alias("label"))


def fitted(blocks: DataFrame, labels: DataFrame) -> Model:
    """A model from the sample: the TRAIN_BLOCKS labelled blocks with the least hash of their id."""
    ids = labels.where(F.col("label").isin(LANGS)).select("block_id", "label").orderBy(F.xxhash64("block_id"), "block_id").limit(TRAIN_BLOCKS)
    rows = blocks.select("block_id", "text").where("text is not null").join(F.broadcast(cut(ids)), "block_id").orderBy("block_id").toPandas()
    parts, ys = [], []
    for t, y in zip(rows["text"], rows["label"]):
        for s in sentences(t):
            if len(_WORD.findall(s)) >= LEAST_WORDS and s.rstrip()[-1:] in ".!?…":
                parts.append(s)
                ys.append(LANGS.index(y))
    keep = np.random.default_rng(1).permutation(len(parts))[:TRAIN_SENTENCES]
    parts, ys = [parts[i] for i in keep], [ys[i] for i in keep]
    return train(parts, np.array(ys, dtype=np.int64)) if parts else Model(np.zeros((BUCKETS, len(LANGS) + 1), dtype=np.float32), np.zeros(len(LANGS)), 1.0)


def segments(text: str, model: Model) -> list[tuple[str, str, float]]:
    """(sentence, language, confidence) of each sentence of one text."""
    ss = sentences(text)
    if not ss:
        return []
    p = model.probabilities(ss)
    return [(s, LANGS[i], float(x)) for s, i, x in zip(ss, p.argmax(axis=1), p.max(axis=1))]


def joined(found: list[tuple[str, str, float]]) -> list[tuple[str, float, int, str]]:
    """(language, least confidence, sentences, text) of runs of sentences of one language."""
    out: list[tuple[str, float, int, str]] = []
    for text, lang, sure in found:
        if out and out[-1][0] == lang:
            _, low, n, before = out[-1]
            out[-1] = (lang, min(low, sure), n + 1, f"{before} {text}")
        else:
            out.append((lang, sure, 1, text))
    return out


_FOUND = "array<struct<lang:string,sentences:int,confidence:double>>"


def languages(texts: list[str | None], model: Model) -> list[list[tuple[str, int, float]]]:
    """Per text the languages that have at least one sentence, with their numbers of sentences and highest confidence. A
    text without a sentence that is long enough has the language of the whole of it."""
    parts, owner = [], []
    for k, t in enumerate(texts):
        if isinstance(t, str):
            for s in sentences(t):
                parts.append(s)
                owner.append(k)
    out: list[dict[str, list[float]]] = [{} for _ in texts]
    if not parts:
        return [[] for _ in texts]
    p = model.probabilities(parts)
    best, sure = p.argmax(axis=1).tolist(), p.max(axis=1).tolist()
    weak: list[dict[str, list[float]]] = [{} for _ in texts]
    for k, s, i, x in zip(owner, parts, best, sure):
        strong = x >= SURE and s.count(" ") >= LEAST_WORDS - 1 and sum(map(str.isalpha, s[: 4 * LEAST_LETTERS])) >= LEAST_LETTERS
        (out if strong else weak)[k].setdefault(LANGS[i], []).append(x)
    for k, found in enumerate(out):
        if not found and weak[k]:
            lang = max(weak[k], key=lambda x: sum(weak[k][x]))
            found[lang] = weak[k][lang]
    return [[(lang, len(v), max(v)) for lang, v in sorted(found.items())] for found in out]


def _model_for(blocks: DataFrame, labels: DataFrame):
    return blocks.sparkSession.sparkContext.broadcast(fitted(blocks, labels))


def _found(model):
    @F.pandas_udf(_FOUND)
    def langs(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"lang": a, "sentences": n, "confidence": c} for a, n, c in x] for x in languages(texts.tolist(), model.value)])

    return langs


def block_languages(blocks: DataFrame, labels: DataFrame) -> DataFrame:
    """``blocks`` (with ``block_id`` and ``found``, the languages of the text) with the label they came with and ``is_case``:
    without a usable label, with a label or ``is_uzbek`` that contradicts the text, or with several languages. ``labels`` is
    the outcome of ``latest``, so a block scored twice counts with the row scored last. A text without words has no language
    and is no case."""
    b = blocks.join(labels, "block_id", "left")
    codes = F.transform("found", lambda x: x["lang"])
    uzbek = F.array_contains(codes, "uz")
    contradicts = ~F.array_contains(codes, F.col("label")) | (F.col("is_uzbek") & ~uzbek) | (~F.col("is_uzbek") & uzbek)
    case = (F.size("found") > 0) & (F.col("label").isNull() | F.coalesce(contradicts, F.lit(False)) | (F.size("found") > 1))
    return b.withColumn("is_case", F.coalesce(case, F.lit(False)))


def relabelled(blocks: DataFrame, results: DataFrame, common: DataFrame) -> DataFrame:
    """(block_id, lang, sentences, confidence): one row per language of each case that is prose, that is, within the distance
    of problem 1 from the prose of all blocks. Null texts have no language; extra columns are dropped. Texts are read once
    and shuffled nowhere: their languages and statistics leave one pass."""
    labels = cut(latest(results))
    langs = _found(_model_for(blocks, labels))
    texts = blocks.where("text is not null").select("block_id", langs("text").alias("found"), "text")
    stats = cut(statistics(texts, common))
    prose = scored(stats, prose_model(stats)).where("kind is null").select("block_id", "found")
    cases = block_languages(prose, labels).where("is_case")
    return cases.select("block_id", F.explode("found").alias("f")).select("block_id", "f.lang", "f.sentences", "f.confidence")


def block_segments(blocks: DataFrame, results: DataFrame) -> DataFrame:
    """(block_id, segment_no, lang, confidence, n_sentences, text): the segments of every block, which are its sentences with
    neighbours of one language put together; ``confidence`` is the least of them. Null and empty texts have no segments."""
    model = _model_for(blocks, cut(latest(results)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(i, k, *s) for i, t in zip(b["block_id"], b["text"]) for k, s in enumerate(joined(segments(t, model.value)))]
            yield pd.DataFrame(rows, columns=["block_id", "segment_no", "lang", "confidence", "n_sentences", "text"])

    return blocks.where("text is not null").select("block_id", "text").mapInPandas(run, "block_id bigint, segment_no int, lang string, confidence double, n_sentences int, text string")
