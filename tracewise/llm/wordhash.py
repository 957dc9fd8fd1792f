"""Vectorised word positions and 64-bit word hashes over UTF-8 bytes.

A word is a maximal run of bytes outside ``\\x20 \\x09-\\x0D``.  Its hash is a
polynomial over a random byte table modulo 2**64, read off one prefix sum
(``R`` is odd, so powers invert), then mixed.  Same bytes give the same hash
in every process."""

from __future__ import annotations

import numpy as np

_BLOCK = 1 << 20
_RNG = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLDED = _BYTE.copy()
_FOLDED[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_R = 0x9E3779B97F4A7C15
_R_INV = pow(_R, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[0] = 1
    return np.multiply.accumulate(out)


_POW = _powers(_R, _BLOCK + 1)
_INV = _powers(_R_INV, _BLOCK + 1)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(30))


def word_spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets [start, end) of the words of ``buf`` (uint8)."""
    inside = np.zeros(len(buf) + 2, np.int8)
    inside[1:-1] = ~_SPACE[buf]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = False) -> np.ndarray:
    """64-bit hash of each word; ``fold`` lower-cases A-Z.  Works block by
    block of whole words, so memory does not grow with the text; a word
    longer than a block is hashed piece by piece."""
    byte = _FOLDED if fold else _BYTE
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        lo = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, lo + _BLOCK, "right")))
        hi = ends[j - 1]
        if hi - lo > _BLOCK:  # one very long word
            h = np.uint64(0)
            with np.errstate(over="ignore"):
                for p in range(lo, hi, _BLOCK):
                    piece = byte[buf[p:min(p + _BLOCK, hi)]]
                    h = mix(np.array([h + (piece * _POW[:len(piece)]).sum(dtype=np.uint64)]))[0]
            out[i] = h
        else:
            acc = np.zeros(hi - lo + 1, np.uint64)
            np.cumsum(byte[buf[lo:hi]] * _POW[:hi - lo], out=acc[1:])
            s, e = starts[i:j] - lo, ends[i:j] - lo
            out[i:j] = mix((acc[e] - acc[s]) * _INV[s] + (e - s).astype(np.uint64))
        i = j
    return out


_STEP = np.uint64(0xD6E8FEB86659FD93)


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive words (order matters)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for k in range(size):
        h = h * _STEP + words[k:k + n]
    return mix(h)


def span_hashes(words: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """Hash of the word runs [start, end) of any lengths, from one prefix sum
    over the word positions."""
    base = (_R * (2 * seed + 1)) & ((1 << 64) - 1)
    base |= 1
    n = len(words)
    acc = np.zeros(n + 1, np.uint64)
    np.cumsum(mix(words + np.uint64(seed)) * _powers(base, max(n, 1))[:n], out=acc[1:])
    inv = _powers(pow(base, -1, 1 << 64), max(n, 1))
    return mix((acc[end] - acc[start]) * inv[np.minimum(start, max(n, 1) - 1)] + (end - start).astype(np.uint64))


def joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of the texts with a newline after each, and the byte
    offset of each text (one more for the end)."""
    enc = [t.encode() for t in texts]
    at = np.zeros(len(enc) + 1, np.int64)
    np.cumsum([len(e) + 1 for e in enc], out=at[1:])
    return np.frombuffer(b"\n".join([*enc, b""]), np.uint8), at
