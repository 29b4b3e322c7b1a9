"""Language score, quality cascade and structure rules as columns. The first rule that holds gives the reason."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from qatlam.functions.text import is_page_number, stripped

#: Fixed values of the language heuristic.
STOPWORDS = [
    "va", "bu", "shu", "u", "biz", "siz", "ular", "men", "sen", "bilan", "uchun", "emas", "ham", "edi", "lekin", "yoki", "uning", "kerak", "keyin", "faqat", "juda", "bor", "kim", "nima",
    "qanday", "qachon", "qayerda", "nega", "yana", "hali", "endi", "albatta", "balki", "chunki", "goyo", "garchi", "toki", "hatto", "deb", "esa",
]
SUFFIXES = ["ning", "lari", "lar", "dan", "gani", "ganda", "gan", "cha", "siz", "lik", "chi", "moq", "ladi", "adi", "yotgan", "ayotgan", "ilgan", "ulgan", "ish", "imiz", "ingiz"]
#: Words that mark front matter, anywhere in the text.
FRONT_MATTER = ["isbn", "udk", "kbk", "nashriyot", "mundarija", "tahrir", "muharrir", "litsenziya"]
#: Fixed value: what counts as a URL or address.
URLISH = r"https?://\S+|www\.\S+|\S+@\S+\.\S+"


@dataclass(frozen=True)
class Thresholds:
    min_chars: int = 25
    min_words: int = 4
    max_symbol_ratio: float = 0.40
    max_repeat_ratio: float = 0.30
    max_upper_ratio: float = 0.70
    max_url_ratio: float = 0.20
    heuristic: float = 0.20
    confidence: float = 0.65


def language_score(c: Column) -> Column:
    """Share of words that are stop-words, hold o' or g', or end in a suffix; each counts, the sum is at most 1. Counted over
    the whole text by four patterns, without an array of its words."""
    t, word = F.lower(c), "[a-z']"
    count = lambda pattern: F.regexp_count(t, F.lit(pattern))
    n = count(f"{word}+")
    stops = count(f"(?<!{word})(?:{'|'.join(STOPWORDS)})(?!{word})")
    signs = count(f"[og]'{word}*+")
    # at the end of each word a look back for a suffix with two letters before it
    ends = count(f"(?<={word})(?!{word})(?<={word}{{2}}(?:{'|'.join(SUFFIXES)}))")
    return F.when(n == 0, 0.0).otherwise(F.least(F.lit(1.0), (stops + signs + ends) / n))


def is_uzbek(score: Column, label: Column | None = None, confidence: Column | None = None, t: Thresholds = Thresholds()) -> Column:
    by_model = (label == "uz") & (confidence >= t.confidence) if label is not None else F.lit(False)
    return F.coalesce(by_model, F.lit(False)) | (score >= t.heuristic)


def quality_reason(c: Column, t: Thresholds = Thresholds()) -> Column:
    """Why a text is dropped, null if it is kept. Nulls count as empty. Lengths are those of what is left when the long rest is
    deleted, patterns that few texts can match are tried behind a cheap test, and the words are listed last, for texts that
    passed all else."""
    c = F.coalesce(c, F.lit(""))
    letter, word = r"\p{L}", r"[\p{L}\p{Nl}\p{No}]"
    spaces = F.length(F.regexp_replace(c, r"[^\s\p{Z}]+", ""))
    other = F.length(F.regexp_replace(c, rf"[{letter}\s\p{{Z}}]+", ""))
    dense = F.length(c) - spaces
    n, letters = F.greatest(dense, F.lit(1)), dense - other
    long_enough = c.rlike(rf"(?s)[^\s\p{{Z}}].{{{t.min_chars - 2},}}[^\s\p{{Z}}]") if t.min_chars >= 2 else F.lit(True)
    enough_words = c.rlike(rf"(?s)(?:{word}++[^\p{{L}}\p{{Nl}}\p{{No}}]++){{{t.min_words - 1}}}{word}") if t.min_words >= 1 else F.lit(True)
    mixed = c.rlike("[A-Za-z]") & c.rlike("[Ѐ-ӿ]") & c.rlike(rf"[A-Za-z]{word}*[Ѐ-ӿ]|[Ѐ-ӿ]{word}*[A-Za-z]")
    # two capitals without a small letter between them: no text without them is mostly in capitals
    upper = F.length(F.regexp_replace(c, r"[^\p{Lu}]+", ""))
    capitals = c.rlike(r"\p{Lu}\P{L}*\p{Lu}") if t.max_upper_ratio > 0.5 else F.lit(True)
    has_url = F.contains(c, F.lit("://")) | F.contains(c, F.lit("www.")) | F.contains(c, F.lit("@"))
    urls = F.aggregate(F.regexp_extract_all(c, F.lit(URLISH), F.lit(0)), F.lit(0), lambda a, x: a + F.length(x))
    words = F.regexp_extract_all(F.lower(c), F.lit(rf"{word}+"), F.lit(0))
    # the longest run of equal words in sorted order
    start = F.struct(F.lit("").alias("w"), F.lit(0).alias("run"), F.lit(0).alias("most"), F.lit(0).alias("n"))

    def step(a: Column, w: Column) -> Column:
        run = F.when(a["w"] == w, a["run"] + 1).otherwise(F.lit(1))
        return F.struct(w.alias("w"), run.alias("run"), F.greatest(a["most"], run).alias("most"), (a["n"] + 1).alias("n"))

    repeated = F.aggregate(F.array_sort(words), start, step, lambda a: a["most"] / F.greatest(a["n"], F.lit(1)))
    return (
        F.when(~long_enough, "juda_qisqa")
        .when(~enough_words, "soz_kam")
        .when(other / n > t.max_symbol_ratio, "simvol_kop")
        .when(mixed, "aralash_alifbo")
        .when(capitals & (upper / F.greatest(letters, F.lit(1)) > t.max_upper_ratio), "katta_harf_kop")
        .when(has_url & (urls / n > t.max_url_ratio), "url_kop")
        .when(repeated > t.max_repeat_ratio, "ortiqcha_takror")
    )


def structure_reason(text: Column, page: Column, repeated: Column, toc: bool = True, bibliography: bool = True, front_pages: int = 3) -> Column:
    """Why a block is no body text, null if it is. ``repeated`` tells running headers."""
    t = stripped(text)
    marks = F.regexp_count(t, F.lit("[,;]"))
    out = F.when(is_page_number(t), "sahifa_raqami").when(repeated, "kolontitul")
    if toc:
        out = out.when(t.rlike(r"\.{3,}\s*[0-9]{1,4}\s*$"), "mundarija")
    out = out.when((page <= front_pages) & F.lower(t).rlike("|".join(FRONT_MATTER)), "front_matter")
    if bibliography:
        out = out.when((marks >= 3) & t.rlike("(19|20)[0-9]{2}"), "bibliografiya")
    return out


def is_ambiguous(text: Column, page: Column, near_repeated: Column, front_pages: int = 3, front_chars: int = 150) -> Column:
    """Kept blocks that missed a rule by one step."""
    t = stripped(text)
    near_bibliography = (F.regexp_count(t, F.lit("[,;]")) == 2) & (F.length(t) <= 300) & t.rlike("(19|20)[0-9]{2}")
    return near_repeated | ((page <= front_pages) & (F.length(t) <= front_chars)) | near_bibliography


def is_trash(block: Column) -> Column:
    """Advertising labels and short captions."""
    from qatlam.functions.text import clean_lines

    t = stripped(clean_lines(block))
    label = F.regexp_replace(F.lower(t), r"^[ .:—\-\t]+|[ .:—\-\t]+$", "")
    return label.isin("reklama", "advertisement", "реклама", "sponsored", "homiylik materiali") | ((F.length(t) <= 300) & t.rlike(r"(?i)^(foto|surat|video|illustratsiya|manba)\s*:"))
