"""Spelling repair with the corpus as its own dictionary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qatlam.functions.text import core, suffix

#: Letters that are confused, in both directions, at all places of a word at once.
CONFUSED = [("q", "k"), ("g'", "g"), ("h", "x"), ("o'", "u"), ("i", "y")]


def counted(texts: DataFrame, text: str = "text") -> DataFrame:
    """(word, n) of all words of the texts."""
    return words(texts, text).groupBy("word").agg(F.count("*").alias("n"))


def words(texts: DataFrame, text: str = "text") -> DataFrame:
    """(word): lower-case tokens without trailing punctuation, one row each."""
    t = texts.where(F.col(text).isNotNull()).select(F.explode(F.split(F.lower(text), r"[\s\p{Z}]+")).alias("t"))
    return t.select(core(F.col("t")).alias("word")).where("word <> ''")


def dictionary(texts: DataFrame, text: str = "text", least: int = 3) -> DataFrame:
    """(word, n): words frequent enough to be trusted."""
    return counted(texts, text).where(F.col("n") >= least)


def corrections(found: DataFrame, trusted: DataFrame) -> DataFrame:
    """(word, correction): words that are not trusted themselves and of whose ten variants exactly one is. Works on distinct
    words; both joins are on words."""
    w = found.select("word").distinct().join(trusted.select("word"), "word", "left_anti")
    variants = [F.replace("word", F.lit(a), F.lit(b)) for x, y in CONFUSED for a, b in ((x, y), (y, x))]
    v = w.select("word", F.explode(F.array_distinct(F.array(*variants))).alias("correction")).where("word <> correction")
    good = v.join(trusted.select(F.col("word").alias("correction")), "correction", "left_semi")
    return good.groupBy("word").agg(F.count("*").alias("n"), F.min("correction").alias("correction")).where("n = 1").drop("n")


def corrected_lines(texts: DataFrame, key: str, fixes: DataFrame, text: str = "text") -> DataFrame:
    """(key, corrected): every text with the words of ``fixes`` (word, correction) replaced line by line; a word keeps its first
    letter's case and the punctuation behind it. Lines of white space stay; of other lines the words are joined by one space.
    Only words with a correction are joined back to their text; the texts themselves are rewritten in place from a map each."""
    t = texts.where(F.col(text).isNotNull()).select(key, text)
    hits = t.select(key, F.explode(F.array_distinct(F.split(F.lower(text), r"[\s\p{Z}]+"))).alias("t")).select(key, core(F.col("t")).alias("word")).where("word <> ''").distinct()
    maps = hits.join(fixes.select("word", "correction"), "word").groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("word", "correction"))).alias("_fixes"))

    def token(x):
        c = core(x)
        fix = F.try_element_at(F.col("_fixes"), F.lower(c))
        first = F.substring(c, 1, 1)
        cased = F.when(first != F.lower(first), F.concat(F.upper(F.substring(fix, 1, 1)), F.substring(fix, 2, 1 << 30))).otherwise(fix)
        return F.when(fix.isNotNull(), F.concat(cased, suffix(x))).otherwise(x)

    def line(x):
        kept = F.filter(F.split(x, r"[\s\p{Z}]+"), lambda w: w != "")
        return F.when(x.rlike(r"[^\s\p{Z}]"), F.array_join(F.transform(kept, token), " ")).otherwise(x)

    fixed = F.array_join(F.transform(F.split(text, "\n"), line), "\n")
    return t.join(maps, key, "left").select(key, fixed.alias("corrected"))
