"""Per-chunk work done once per distinct chunk of a group of texts.

A text is a sequence of chunks: a run of separators and the characters up to
the next run. Operators whose result for a text is the concatenation of results
for its chunks (words, token ids, hashes) compute them per distinct chunk, and
the occurrences are assembled by array operations.
"""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

GROUP_BYTES = 1 << 20
_rng = np.random.default_rng(7)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = 0x9E3779B97F4A7C15
# last bytes of white space outside ASCII, and the lead bytes of those characters
_WIDE_LAST = np.zeros(256, bool)
_WIDE_LAST[[0x80, 0x81, 0x82, 0x83, 0x84, 0x85, 0x86, 0x87, 0x88, 0x89, 0x8A, 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]] = True
_WIDE_LEAD = np.zeros(256, bool)
_WIDE_LEAD[[0xC2, 0xE1, 0xE2, 0xE3]] = True
_ODD = np.zeros(256, bool)
_ODD[[0x0B, 0x0C, 0x1C, 0x1D, 0x1E, 0x1F]] = True

_LETTER = np.zeros(256, bool)
_LETTER[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = True
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

_powers: dict[str, np.ndarray] = {}


_held: list[dict] = []
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None


def release() -> None:
    """Memory that is free in this worker goes back to the system, for the other processes of the executor."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def hold(state: dict) -> dict:
    """One operator's caches per Python worker: those of the operator before it are dropped."""
    if not _held or _held[0] is not state:
        for other in _held:
            other.clear()
        _held[:] = [state]
        gc.collect()
        release()
    return state


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64, up to n."""
    if len(_powers.get("up", ())) < n:
        size = n + (n >> 2)
        for name, base in (("up", _STEP), ("down", pow(_STEP, -1, 1 << 64))):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            _powers[name] = np.cumprod(x, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def groups(texts: list[bytes], most: int = GROUP_BYTES):
    """(first row, texts) in groups of about ``most`` bytes; a text is never cut."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= most:
            yield start, texts[start:i + 1]
            start, size = i + 1, 0
    if start < len(texts):
        yield start, texts[start:]


def text_groups(column: pa.Array, most: int = GROUP_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """``groups`` of a text column, a null as the empty text: only one group at a time is taken out of the batch, and
    what the groups took is given back after each of them."""
    column = column.cast(pa.binary())
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(column), 0), np.int64))
    start = 0
    while start < len(column):
        after = int(np.searchsorted(ends, (ends[start - 1] if start else 0) + most)) + 1
        yield start, [t or b"" for t in column.slice(start, after - start).to_pylist()]
        start = after
        release()


class Chunks:
    """Maps texts to concatenated per-chunk values.

    ``make`` gets new distinct chunks (as bytes) and returns the values of each as raw
    bytes of ``dtype``; a worker keeps up to ``most`` chunks and starts anew beyond that.
    ``tails``: characters before which a run of ASCII letters also ends a chunk.
    """

    def __init__(self, make: Callable[[list[bytes]], list[bytes]], dtype, separators: bytes = b" \n\t\r",
                 tails: bytes = b"", most: int = 1_000_000):
        self.make, self.dtype, self.most = make, np.dtype(dtype), most
        self.known: dict[bytes, bytes] = {}
        self.sep = np.zeros(256, bool)
        self.sep[list(separators)] = True
        self.tail = np.zeros(256, bool)
        self.tail[list(tails)] = True

    def _starts(self, buf: np.ndarray, begin: np.ndarray) -> np.ndarray:
        sep = self.sep[buf]
        flag = np.zeros(len(buf), bool)
        at = np.flatnonzero(sep[1:] & ~sep[:-1]) + 1
        # no cut after white space outside the separators: a piece may span both
        before = buf[at - 1]
        wide = _WIDE_LAST[before] & (_WIDE_LEAD[buf[at - 2]] | _WIDE_LEAD[buf[at - 3]])
        flag[at[~(wide | _ODD[before])]] = True
        flag[1:] |= self.tail[buf[1:]] & _LETTER[buf[:-1]]
        flag[begin] = True
        return np.flatnonzero(flag)

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(values of all texts in a row, number of values of each text)."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        counts = np.zeros(len(texts), np.int64)
        data = b"".join(texts)
        if not data:
            return np.empty(0, self.dtype), counts
        buf = np.frombuffer(data, np.uint8)
        filled = np.flatnonzero(sizes)
        begin = (np.cumsum(sizes) - sizes)[filled]
        starts = self._starts(buf, begin)
        ends = np.append(starts[1:], len(buf))
        up, down = _power(len(buf))
        total = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(_BYTE[buf] * up[:len(buf)], out=total[1:])
        codes, distinct = pd.factorize((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
        first = np.empty(len(distinct), np.int64)
        first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
        keys = [data[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]
        known = self.known
        new = [k for k in keys if k not in known]
        if len(known) + len(new) > self.most:
            known.clear()
            new = list(dict.fromkeys(keys))
        known.update(zip(new, self.make(new)))
        values = [known[k] for k in keys]
        pool = np.frombuffer(b"".join(values), self.dtype)
        length = np.fromiter(map(len, values), np.int64, len(values)) // self.dtype.itemsize
        offset = np.cumsum(length) - length
        each = length[codes]
        before = np.cumsum(each) - each
        out = pool[np.repeat(offset[codes] - before, each) + np.arange(before[-1] + each[-1])]
        counts[filled] = np.add.reduceat(each, np.searchsorted(starts, begin))
        return out, counts
