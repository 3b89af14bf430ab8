"""Words of a text: runs of letters and digits, without regard to case, compatibility forms and invisible characters."""

from __future__ import annotations

import re
import sys
import unicodedata

import numpy as np
import xxhash

_FORMAT = {c: None for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Cf"}
_FORMAT_CHARACTERS = frozenset(map(chr, _FORMAT))
_WORD = re.compile(r"[^\W_]+")
_CACHE_LIMIT = 1_000_000


def _compatible(text: str) -> str:
    return text if unicodedata.is_normalized("NFKC", text) else unicodedata.normalize("NFKC", text)


def fold(text: str) -> str:
    """Lower-cased compatibility form of text without format characters."""
    if text.isascii():
        return text.lower()
    if not _FORMAT_CHARACTERS.isdisjoint(text):
        text = text.translate(_FORMAT)
    return _compatible(_compatible(text).casefold())


def split_words(folded: str) -> list[str]:
    return _WORD.findall(folded)


def words(text: str) -> list[str]:
    return _WORD.findall(fold(text))


class WordHasher:
    """Stable 64-bit hashes of words. The memory of hashes is emptied when full; values don't depend on it."""

    def __init__(self) -> None:
        self.seen: dict[str, int] = {}

    def __call__(self, ws: list[str]) -> np.ndarray:
        seen = self.seen
        if len(seen) > _CACHE_LIMIT:
            seen.clear()
        out = []
        for w in ws:
            h = seen.get(w)
            if h is None:
                h = seen[w] = xxhash.xxh3_64_intdigest(w)
            out.append(h)
        return np.array(out, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over 64 bits."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(32))


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Distinct hashes of width consecutive words; empty for shorter texts."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    x = hashes[:n].copy()
    for k in range(1, width):
        x = mix(x) + hashes[k : k + n]
    return np.unique(mix(x))
