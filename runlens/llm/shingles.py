"""Hashes of words and word shingles, shared by the similarity operators."""

from __future__ import annotations

import numpy as np

from runlens.llm.common import words_of
from runlens.llm.ragged import PUNCTUATION, Chunks, hold

CACHE_CHUNKS = 150_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_state: dict = {}


def _hash_chunks(chunks: list[bytes]) -> list[bytes]:
    import xxhash

    return [b"".join(xxhash.xxh3_64_intdigest(w).to_bytes(8, "little") for w in words_of(c.decode())) for c in chunks]


def word_hashes(texts: list[bytes]) -> list[np.ndarray]:
    """64-bit hashes of each text's words, in order."""
    hold(_state)
    if "words" not in _state:
        _state["words"] = Chunks(_hash_chunks, np.uint64, tails=PUNCTUATION, most=CACHE_CHUNKS)
    values, counts = _state["words"](texts)
    return np.split(values, np.cumsum(counts)[:-1])


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of every run of k words, in text order."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    s = words[:n].copy()
    for j in range(1, k):
        s *= _BASE
        s += words[j:n + j]
    s ^= s >> np.uint64(31)
    s *= np.uint64(0xBF58476D1CE4E5B9)
    s ^= s >> np.uint64(29)
    return s
