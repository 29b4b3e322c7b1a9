"""Per-row text transforms as column builders: transliteration, token and line cleaning, normalisation, PII, token estimates.

All builders take and return columns and stay in the JVM; null in, null out unless a docstring says otherwise.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Cyrillic letters and their Latin spelling; е and ц depend on their neighbours.
CYRILLIC = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "ё": "yo", "ж": "j", "з": "z", "и": "i", "й": "y", "к": "k", "л": "l", "м": "m", "н": "n", "о": "o",
    "п": "p", "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f", "х": "x", "ч": "ch", "ш": "sh", "щ": "sh", "ъ": "'", "ь": "", "э": "e", "ю": "yu", "я": "ya",
    "ў": "o'", "қ": "q", "ғ": "g'", "ҳ": "h",
}
VOWELS = "аеёиоуэюя"
WORD_LETTERS = "a-zA-Zа-яА-ЯёЁўЎқҚғҒҳҲ"
APOSTROPHES = "'‘’ʻʼ`´"
QUOTES = "«»“”„"
INVISIBLE = "​‌‍﻿­"
#: Edit links that wikis leave in headings.
WIKI_EDIT = ["manbasini tahrirlash", "tahrirlash", "tahrir", "edit", "изменить", "редактировать"]

#: Patterns of page numbers, bylines, addresses and phone numbers.
PAGE_NUMBER = r"(?i)^[-–—\s]*[0-9]{1,4}[-–—\s]*(bet)?[-–—\s]*$"
BYLINE = r"(?i)^(mas'ul\s+)?(muallif(i)?|muharrir(i)?|tuzuvchi(si)?|tahrir(chi)?(si)?|tarjimon(i)?)\s*:\s*\S.*$"
EMAIL = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
PHONE = r"\+998[\s-]?[0-9]{2}[\s-]?[0-9]{3}[\s-]?[0-9]{2}[\s-]?[0-9]{2}|\b0[0-9]{2}[\s-]?[0-9]{3}[\s-]?[0-9]{2}[\s-]?[0-9]{2}\b"
SPACE = r"[\s\p{Z}]"


def stripped(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(c, rf"^{SPACE}+|{SPACE}+$", "")


def to_latin(c: Column) -> Column:
    """Cyrillic words in Latin letters: a capital is expanded in capitals within an all-capital word, else in title case;
    Latin words, digits and signs stay. Works on whole texts by a fixed number of replacements; whether a word is all in
    capitals is looked up 60 letters back."""
    low, v = "a-zа-яёўқғҳ", VOWELS + VOWELS.upper()
    # each pattern starts with the letter itself, so the look-arounds run at that letter only
    caps = f"(?<![{low}][{WORD_LETTERS}]{{1,60}})(?![{WORD_LETTERS}]*[{low}])"
    x = c
    for letter, t in (("ц", "ts"), ("е", "ye")):
        for k in (letter.upper(), letter):
            here = f"{k}(?:(?<![{WORD_LETTERS}]{k})|(?<=[{v}]{k}){f'(?=[{v}])' if letter == 'ц' else ''})"
            if k != letter:
                x = F.regexp_replace(x, here + caps, t.upper())
            x = F.regexp_replace(x, here, t if k == letter else t.title())
    for k, t in CYRILLIC.items():
        if len(t) == 2 and t[1].isalpha():
            x = F.regexp_replace(x, k.upper() + caps, t.upper())
    letters = CYRILLIC | {"е": "e", "ц": "s"}
    letters |= {k.upper(): s[:1].upper() + s[1:] for k, s in letters.items()}
    for k, t in letters.items():
        if len(t) > 1:
            x = F.replace(x, F.lit(k), F.lit(t))
    one = {k: t for k, t in letters.items() if len(t) == 1}
    x = F.translate(x, "".join(one) + "ьЬ", "".join(one.values()))
    return F.when(c.rlike("[а-яА-ЯёЁўЎқҚғҒҳҲ]"), x).otherwise(c)


def good_token(t: Column) -> Column:
    """Whether a token is no scanning garbage: known characters only, no lone letter, no digits fused with letters but for
    forms like 5-bet and nashr-0."""
    bad_char = t.rlike(r"[^\p{L}\p{Nd}'\-.,!?:;()\"«»–—…]")
    lone = t.rlike(r"^\p{L}$")
    fused = t.rlike(r"\p{Nd}") & t.rlike(r"\p{L}")
    fine = t.rlike(r"^\p{Nd}+-\p{L}+[.,!?:;]*$") | t.rlike(r"^\p{L}+-\p{Nd}+[.,!?:;]*$")
    return ~(bad_char | lone | (fused & ~fine))


def strip_garbage_line(line: Column) -> Column:
    kept = F.filter(F.split(line, rf"{SPACE}+"), lambda t: (t != "") & good_token(t))
    return F.when(line.rlike(r"[^\s\p{Z}]"), F.array_join(kept, " ")).otherwise(line)


def strip_garbage(c: Column) -> Column:
    """Each line without garbage tokens; lines of white space stay as they are."""
    return F.array_join(F.transform(F.split(c, "\n"), strip_garbage_line), "\n")


@F.pandas_udf(StringType())
def nfc(s: pd.Series) -> pd.Series:
    """Unicode composition, which has no built-in; apply it to the rows that have combining marks."""
    return s.map(lambda x: unicodedata.normalize("NFC", x) if isinstance(x, str) else None)


def normalized(c: Column, apostrophe: str = "'") -> Column:
    """Wiki edit links, invisible signs, dashes, words broken at line ends, apostrophes, quotes and white space in one form.
    Composed text is assumed; see ``nfc``."""
    links = "|".join(WIKI_EDIT)
    c = F.regexp_replace(c, rf"(?iu)\[\s*(?:{links})(?:\s*\|\s*(?:{links}))*\s*\]", "")
    c = F.regexp_replace(c, f"[{INVISIBLE}]", "")
    c = F.regexp_replace(c, "[–—]", "-")
    c = F.regexp_replace(c, r"([\p{L}\p{N}_])-\n([\p{L}\p{N}_])", "$1$2")
    c = F.regexp_replace(c, f"[{APOSTROPHES}]", apostrophe)
    c = F.regexp_replace(c, f"[{QUOTES}]", '"')
    c = F.regexp_replace(c, r"[ \t]+", " ")
    c = F.regexp_replace(c, " \n", "\n")
    return stripped(F.regexp_replace(c, "\n{3,}", "\n\n"))


def dedup_form(c: Column) -> Column:
    """Lower case, trimmed, white space collapsed."""
    return F.regexp_replace(stripped(F.lower(c)), rf"{SPACE}+", " ")


def content_hash(c: Column) -> Column:
    """SHA-1 of the form that exact and normalised duplicates share."""
    return F.sha1(dedup_form(c))


def repeat_form(c: Column) -> Column:
    """What repeats of a running header share: no digits, collapsed, trimmed, lower case."""
    return F.lower(stripped(F.regexp_replace(F.regexp_replace(c, r"\p{Nd}+", ""), rf"{SPACE}+", " ")))


def _no_mail(c: Column) -> Column:
    """Without e-mail addresses; the pattern is tried only on texts that can hold one."""
    return F.when(F.contains(c, F.lit("@")), F.regexp_replace(c, EMAIL, "")).otherwise(c)


def scrub_pii(c: Column) -> Column:
    """Without e-mail addresses and phone numbers; spaces around them stay."""
    return F.regexp_replace(_no_mail(c), PHONE, "")


def pii_count(c: Column) -> Column:
    mails = F.when(F.contains(c, F.lit("@")), F.regexp_count(c, F.lit(EMAIL))).otherwise(F.when(c.isNotNull(), 0))
    return mails + F.regexp_count(_no_mail(c), F.lit(PHONE))


def is_page_number(line: Column) -> Column:
    return stripped(line).rlike(PAGE_NUMBER)


def is_byline(line: Column) -> Column:
    return stripped(line).rlike(BYLINE)


def denoised_line(line: Column) -> Column:
    return F.when(is_page_number(line) | is_byline(line), "").otherwise(strip_garbage_line(line))


def denoised(c: Column) -> Column:
    """Page-number and byline lines emptied, other lines without garbage tokens; the number of lines stays."""
    return F.array_join(F.transform(F.split(c, "\n"), denoised_line), "\n")


def changed_lines(c: Column) -> Column:
    return F.size(F.filter(F.split(c, "\n"), lambda x: denoised_line(x) != x))


def core(token: Column) -> Column:
    """A token without its trailing punctuation."""
    return F.regexp_extract(token, r'(?s)^(.*?)([.,!?:;)"»]*)$', 1)


def suffix(token: Column) -> Column:
    return F.regexp_extract(token, r'(?s)^(.*?)([.,!?:;)"»]*)$', 2)


def corrected(line: Column, fixes: Column) -> Column:
    """A line with the known corrections (a map from lower-case words) applied token by token, always capitalised."""

    def one(t: Column) -> Column:
        fix = F.try_element_at(fixes, F.lower(core(t)))
        return F.when(fix.isNotNull(), F.concat(F.upper(F.substring(fix, 1, 1)), F.substring(fix, 2, 1_000_000), suffix(t))).otherwise(t)

    return F.array_join(F.transform(F.filter(F.split(line, rf"{SPACE}+"), lambda t: t != ""), one), " ")


def corrected_text(c: Column, fixes: Column) -> Column:
    """``corrected`` line by line."""
    return F.array_join(F.transform(F.split(c, "\n"), lambda x: corrected(x, fixes)), "\n")


def paragraphs(c: Column) -> Column:
    """The paragraphs of a plain text: what stands between blank lines, trimmed, without empty ones."""
    return F.filter(F.transform(F.split(c, "\n\n"), stripped), lambda x: x != "")


def _letters(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}_]+", "")


def composed(title: Column, blocks: Column) -> Column:
    """An article: its title with a full stop, a blank line and its blocks; a first block that repeats the title goes."""
    content = F.filter(blocks, lambda b: stripped(b) != "")
    key = _letters(clean_lines(F.coalesce(title, F.lit(""))))
    repeats = (key != "") & (_letters(F.get(content, F.lit(0))) == key)
    content = F.when(F.coalesce(repeats, F.lit(False)), F.slice(content, 2, 1 << 30)).otherwise(content)
    head = title_with_stop(F.coalesce(title, F.lit("")))
    body = stripped(F.array_join(content, "\n\n"))
    return stripped(F.when(head == "", body).otherwise(F.concat(head, F.lit("\n\n"), body)))


def token_count(n_chars: Column, chars_per_token: float = 4.0) -> Column:
    """Estimate from a number of characters: 0 for none, else at least 1; halves round to even."""
    if chars_per_token <= 0:
        raise ValueError("chars_per_token must be positive")
    return F.when(n_chars == 0, 0).when(n_chars > 0, F.greatest(F.lit(1), F.bround(n_chars / F.lit(chars_per_token)))).cast("bigint")


def token_estimate(c: Column, chars_per_token: float = 4.0) -> Column:
    return token_count(F.length(c), chars_per_token)


def clean_lines(c: Column) -> Column:
    """White space of each line collapsed, none before punctuation, no empty and no consecutive equal lines, joined by blank
    lines. Entities are decoded where HTML is read."""
    lines = F.transform(F.split(F.regexp_replace(c, "\r\n?", "\n"), "\n"), lambda x: F.regexp_replace(F.regexp_replace(stripped(x), rf"{SPACE}+", " "), r" +([.,:;!?])", "$1"))
    lines = F.filter(lines, lambda x: x != "")
    kept = F.filter(lines, lambda x, i: (i == 0) | (x != F.get(lines, F.greatest(i - 1, F.lit(0)))))
    return F.array_join(kept, "\n\n")


def title_with_stop(title: Column) -> Column:
    t = stripped(clean_lines(title))
    return F.when((t != "") & ~F.right(t, F.lit(1)).isin(".", "!", "?", "…"), F.concat(t, F.lit("."))).otherwise(t)


def slug(name: Column) -> Column:
    return F.regexp_replace(name, "[^a-zA-Z0-9_-]+", "_")


def category_name(c: Column) -> Column:
    """A library category's name with one form of apostrophe, trimmed."""
    return F.translate(stripped(c), "‘’ʼ`´", "'''''")
