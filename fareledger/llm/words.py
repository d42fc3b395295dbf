"""Words of many texts at once: boundaries and 64-bit fingerprints by numpy over the UTF-8 bytes.

A word is a run of code points other than space and U+0009 to U+000D; A-Z count as a-z. These
bytes never occur inside a longer UTF-8 sequence, so no text is decoded. Two words have the same
fingerprint if they are equal; different words share one with a chance of about 2^-64.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_SEED = 20240229
_RNG = np.random.default_rng(_SEED)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
#: A random 64-bit value of each byte, and the same for upper and lower case.
EXACT = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
FOLDED = EXACT[_LOWER]
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _MIX1
    x ^= x >> np.uint64(27)
    x *= _MIX2
    x ^= x >> np.uint64(31)
    return x


class _Powers:
    """Powers of the odd step and of its inverse modulo 2^64, as far as needed so far."""

    def __init__(self) -> None:
        self.up = self.down = np.zeros(0, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            up, down = (np.full(n, x, np.uint64) for x in (int(_STEP), pow(int(_STEP), -1, 2**64)))
            up[:1] = down[:1] = 1
            self.up, self.down = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
        return self.up, self.down


_POWERS = _Powers()


@dataclass
class Words:
    """Words of a slice of texts: ``first[i]:first[i + 1]`` are those of text ``i``."""

    prints: np.ndarray  # uint64 fingerprint of each word
    first: np.ndarray   # int64, one more than there are texts
    start: np.ndarray   # byte offset of each word in ``data``
    stop: np.ndarray
    data: np.ndarray    # bytes of all texts

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def word(self, i: int) -> bytes:
        return self.data[self.start[i]:self.stop[i]].tobytes()


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the int64 offset of each text; null is empty."""
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None and len(at) else np.zeros(0, np.uint8)
    return raw, at - at[0]


def is_space(data: np.ndarray) -> np.ndarray:
    return _SPACE[data]


def split(texts: pa.Array) -> Words:
    """All words of all texts, nothing cut."""
    data, at = buffers(texts)
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~_SPACE[data]
    begins, ends = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    edges = at[(at > 0) & (at < len(data))]  # a word never spans two texts
    begins[edges] = inside[1:-1][edges]
    ends[edges - 1] = inside[1:-1][edges - 1]
    start, stop = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    first = np.searchsorted(start, at)
    return Words(prints(data, start, stop), first, start, stop, data)


def prints(data: np.ndarray, start: np.ndarray, stop: np.ndarray, values: np.ndarray = FOLDED) -> np.ndarray:
    """Fingerprint of each byte range ``start:stop`` of ``data``: a polynomial of its bytes.

    One running sum over all bytes serves every range; dividing by the power at the range's
    start (the step is odd, so it has an inverse) makes it independent of where the range lies.
    """
    up, down = _POWERS.to(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.multiply(values[data], up[:len(data)], out=total[1:])
    np.cumsum(total, out=total)
    return mix((total[stop] - total[start]) * down[start] + (stop - start).astype(np.uint64))


def grams(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of the runs of ``n`` words of each text, and the first run of each text.

    A text of fewer words, but at least one, has one run: all its words.
    """
    counts = words.counts
    runs = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    first = np.concatenate([[0], np.cumsum(runs)])
    begin = np.repeat(words.first[:-1] - first[:-1], runs) + np.arange(first[-1])
    last = np.repeat(words.first[1:], runs)
    out = np.zeros(len(begin), np.uint64)
    padded = np.concatenate([words.prints, np.zeros(n, np.uint64)])
    for k in range(n):
        out *= _STEP
        out += np.where(begin + k < last, padded[begin + k], np.uint64(0))
    return mix(out + np.uint64(n)), first


def mix_fast(x: np.ndarray) -> np.ndarray:
    """A cheap scrambling for values that a multiplication has already spread."""
    return x ^ (x >> np.uint64(29))
