"""Folding of words to a form that ignores script, case, apostrophes and invisible signs.

Plain Python, used inside Arrow-batched functions only.
"""

from __future__ import annotations

import html
import re

#: Cyrillic letters and their usual Latin spelling (Uzbek, with the Russian and Kazakh rest).
LATIN = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ё": "yo", "ж": "j", "з": "z", "и": "i", "й": "y",
    "к": "k", "л": "l", "м": "m", "н": "n", "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f",
    "х": "x", "ц": "s", "ч": "ch", "ш": "sh", "щ": "sh", "ъ": "", "ы": "i", "ь": "", "э": "e", "ю": "yu", "я": "ya",
    "ў": "o", "қ": "q", "ғ": "g", "ҳ": "h", "і": "i", "ө": "o", "ң": "n", "ұ": "u", "ү": "u", "ә": "a", "һ": "h",
}
APOSTROPHES = "'’‘ʻʼ`´′ʹ‛＇"
INVISIBLE = "​‌‍⁠﻿­"

_DROP = {ord(c): None for c in APOSTROPHES + INVISIBLE}
_FOLD = _DROP | {ord(k): v for k, v in LATIN.items()}
_APOS = re.compile("[" + APOSTROPHES + INVISIBLE + "]")
_CYR = re.compile("[а-яёўқғҳіөңұүәһ]")
_WORD = re.compile(r"[^\W_]+")


def folded(text: str) -> str:
    """``text`` in lower-case Latin letters without apostrophes."""
    if "&" in text:
        text = html.unescape(text)
    t = text.lower()
    if t.isascii():
        return t.replace("'", "").replace("`", "").replace("ye", "e").replace("ts", "s")
    if _CYR.search(t):
        t = t.translate(_FOLD)
    else:
        t = _APOS.sub("", t)
    return t.replace("ye", "e").replace("ts", "s")


def words(text: str) -> list[str]:
    """Folded words of ``text`` in order; digits count as words."""
    return _WORD.findall(folded(text))


def plain_words(text: str) -> list[str]:
    """Words in lower case without apostrophes, in the script in which they are written."""
    return _WORD.findall(_APOS.sub("", text.lower()))
