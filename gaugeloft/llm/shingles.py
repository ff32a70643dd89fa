"""Word shingles as 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

from gaugeloft.llm.common import mixed

CACHED_WORDS = 200_000
_hashes: dict[bytes, int] = {}


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space (space, 0x09-0x0D), A-Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A hash per word. Known words come from a table, which starts anew when it is full."""
    known, digest = _hashes, xxhash.xxh3_64_intdigest
    if len(known) > CACHED_WORDS:
        known.clear()
    out = []
    for word in words:
        h = known.get(word)
        if h is None:
            h = known[word] = digest(word)
        out.append(h)
    return np.array(out, dtype=np.uint64)


def gram_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash per run of ``size`` words, in order; with fewer words, one of the whole sequence."""
    if not len(hashes):
        return hashes
    size = min(size, len(hashes))
    out = np.full(len(hashes) - size + 1, size, dtype=np.uint64)
    for j in range(size):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + hashes[j : len(hashes) - size + 1 + j])
    return out


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """The distinct shingles of a text, sorted; none without words."""
    return np.unique(gram_hashes(word_hashes(words_of(text)), size))
