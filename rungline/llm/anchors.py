"""Anchors of byte strings: where equal stretches of two texts can be found without comparing all positions.

Every window of ``window`` bytes picks one of its ``gram``-byte strings: the one with the smallest hash, the leftmost of equals.
The choice depends on the window's bytes alone, so equal windows pick the same string at the same offset, whatever surrounds them.
"""
from __future__ import annotations

import numpy as np
import xxhash

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_LETTERS = np.array([xxhash.xxh64_intdigest(bytes([b]), 7) for b in range(256)], dtype=np.uint64)
#: Windows handled at once; positions within a part fit the low bits of a key.
_PART, _LOW = 1 << 19, np.uint64((1 << 20) - 1)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 4096), base, dtype=np.uint64)
        steps[0] = 1
        have = _powers[base] = np.multiply.accumulate(steps)
    return have[:n]


def anchors(text: bytes | np.ndarray, window: int = 400, gram: int = 200) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``at, first, last, code``: each anchor, the first and last window start that picks it, and its hash.

    A text may also be an array of unsigned 64-bit hashes, one per symbol (for instance per word); all lengths then count symbols.
    """
    out = [_part(text, p, min(p + _PART, len(text) - window + 1), window, gram) for p in range(0, len(text) - window + 1, _PART)]
    if not out:
        return (*[np.zeros(0, dtype=np.int64)] * 3, np.zeros(0, dtype=np.uint64))
    at, first, last, code = (np.concatenate(c) for c in zip(*out))
    if len(out) > 1:  # an anchor of two parts is one anchor
        new = np.concatenate([[True], at[1:] != at[:-1]])
        ends = np.append(np.flatnonzero(new)[1:], len(at)) - 1
        at, first, last, code = at[new], first[new], last[ends], code[new]
    return at, first, last, code


def _part(text: bytes | np.ndarray, start: int, end: int, window: int, gram: int) -> tuple[np.ndarray, ...]:
    if isinstance(text, bytes):
        letters = _LETTERS[np.frombuffer(text, dtype=np.uint8)[start:end + window - 1]]
    else:
        letters = text[start:end + window - 1]
    n, width = len(letters), window - gram + 1
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(letters * _power(_BASE, n), out=sums[1:])
    grams = n - gram + 1
    code = (sums[gram:] - sums[:grams]) * _power(_INVERSE, grams)
    code ^= code >> np.uint64(31)
    code *= np.uint64(0xBF58476D1CE4E5B9)
    code ^= code >> np.uint64(29)
    padded = np.full(-(-grams // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:grams] = (code & ~_LOW) | np.arange(grams, dtype=np.uint64)
    rows = padded.reshape(-1, width)
    left = np.minimum.accumulate(rows, axis=1).ravel()
    right = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = n - window + 1
    pick = (np.minimum(right[:windows], left[width - 1:width - 1 + windows]) & _LOW).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], pick[1:] != pick[:-1]]))
    at = pick[new]
    return at + start, new + start, np.append(new[1:], windows) - 1 + start, code[at]
