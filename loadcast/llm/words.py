"""Words of a text as the numbered operators define them, and 64-bit hashes of word sequences.

A word is a run of ``[^\\x20\\x09-\\x0D]``.  On UTF-8 bytes this is what ``bytes.split()`` does:
it cuts at exactly these six bytes, and none of them occurs inside a longer code point.
"""

from __future__ import annotations

import numpy as np
from xxhash import xxh3_64_intdigest

WORD_SQL = "[^\\\\x20\\\\x09-\\\\x0D]+"
GAP_SQL = "[\\\\x20\\\\x09-\\\\x0D]+"

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)


def encode(text: str | None) -> bytes:
    """UTF-8 of a text; null is empty, and a lone surrogate is kept as its three bytes."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def split_words(text: str | None, lower: bool = False) -> list[bytes]:
    raw = encode(text)
    return (raw.lower() if lower else raw).split()


def hash_words(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def sequence_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` words; with fewer words, of the whole sequence as one."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(width, n)
    out = mix(hashes[: n - width + 1] + np.uint64(width))
    for k in range(1, width):
        out = mix(out * _ODD + hashes[k : n - width + 1 + k])
    return out
