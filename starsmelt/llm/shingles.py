"""Word shingles of whole texts as 64-bit hashes, for many texts at once."""

from __future__ import annotations

import numpy as np

from starsmelt.llm.common import byte_slices

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_TABLE = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_powers: dict[str, np.ndarray] = {}
#: Small, so that what is made of a slice stays in the processor's cache.
SLICE_BYTES = 1 << 20


def _power(name: str, base: int, n: int) -> np.ndarray:
    if len(_powers.get(name, ())) < n:
        steps = np.full(max(n, 2 * SLICE_BYTES), base, np.uint64)
        steps[0] = 1
        _powers[name] = np.cumprod(steps)
    return _powers[name][:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, ASCII letters in lower case, and where each text's words begin.

    Words are runs of bytes other than space and tab to carriage return.
    """
    raw = _LOWER[np.frombuffer(b" ".join([b"", *texts, b""]), np.uint8)]
    bounds = np.concatenate([[1], 1 + np.cumsum([len(t) + 1 for t in texts])])
    blank = _SPACE[raw]
    starts = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    ends = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    total = np.cumsum(_TABLE[raw] * _power("up", _BASE, len(raw)))
    value = (total[ends - 1] - total[starts - 1]) * _power("down", _INVERSE, len(raw))[starts]
    return mix(value + (ends - starts).astype(np.uint64)), np.searchsorted(starts, bounds)


def shingles(texts: list[bytes], size: int) -> list[np.ndarray]:
    """For each text the hashes of its shingles in order; a shorter text is one shingle."""
    out: list[np.ndarray] = []
    for a, b in byte_slices(texts, SLICE_BYTES):
        words, at = word_hashes(texts[a:b])
        full = mix(words[:max(0, len(words) - size + 1)])  # so that the order of words matters
        for k in range(1, size):
            full = mix(full + words[k:k + len(full)])
        for lo, hi in zip(at[:-1].tolist(), at[1:].tolist()):
            if hi - lo >= size:
                out.append(full[lo:hi - size + 1])
            elif hi == lo:
                out.append(words[:0])
            else:
                one = mix(words[lo:lo + 1])
                for k in range(lo + 1, hi):
                    one = mix(one + words[k:k + 1])
                out.append(mix(one + np.uint64(hi - lo)))
    return out


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """For each text its distinct shingles, sorted."""
    return [np.unique(s) for s in shingles(texts, size)]
