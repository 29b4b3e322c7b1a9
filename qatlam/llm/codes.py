"""Words of many texts as 64-bit hashes, in one vectorised pass over their code points."""

from __future__ import annotations

from functools import cache

import numpy as np

from qatlam.llm.fold import APOSTROPHES, INVISIBLE

_SIZE = 1 << 16
ODD = np.uint64(0x9E3779B97F4A7C15)


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    inside, lower = np.zeros(_SIZE, dtype=bool), np.arange(_SIZE, dtype=np.uint64)
    for i in range(_SIZE):
        c = chr(i)
        inside[i] = c.isalnum()
        if len(c.lower()) == 1:
            lower[i] = ord(c.lower())
    dropped = np.zeros(_SIZE, dtype=bool)
    dropped[[ord(c) for c in APOSTROPHES + INVISIBLE]] = True
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(64, ODD, dtype=np.uint64))
    return inside & ~dropped, lower, dropped, powers


def mixed(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F)
        return (h ^ (h >> np.uint64(29))) * ODD


def words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Of all texts together the hash of each word and the number of its text, in order. Words are runs of letters and digits
    in lower case; apostrophes and invisible signs are skipped, as ``fold.plain_words`` does. Code points beyond 2^16 count
    as signs."""
    inside, lower, dropped, powers = _tables()
    cp = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    cp = np.where(cp < _SIZE, cp, 32)
    size = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    keep = ~dropped[cp]
    end = np.cumsum(keep)[np.cumsum(size) - 1] if len(size) else size
    cp = cp[keep]
    step = np.diff(inside[cp].astype(np.int8), prepend=0, append=0)
    first, length = np.flatnonzero(step == 1), np.flatnonzero(step == -1) - np.flatnonzero(step == 1)
    if not len(first):
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    at = np.flatnonzero(inside[cp])
    with np.errstate(over="ignore"):
        product = lower[cp[at]] * powers[(at - np.repeat(first, length)) & 63]
        h = np.add.reduceat(product, np.cumsum(length) - length)
    return mixed(h), np.searchsorted(end, first, side="right")
