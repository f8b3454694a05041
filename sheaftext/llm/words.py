"""Words and shingles of many texts at once, as 64-bit hashes of one flat byte array.

A word is a polynomial in its bytes modulo the prime 2^61 - 1. Two different words of length n have equal values for at
most n of all bases, so no family of words collides for reasons of its form.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

_U = np.uint64
_PRIME = (1 << 61) - 1
_P, _LOW, _29 = _U(_PRIME), _U((1 << 32) - 1), _U((1 << 29) - 1)
_BASE = 0x12F6D1C4B7A3E985 % _PRIME
_INVERSE = pow(_BASE, -1, _PRIME)
_PLACE = np.random.default_rng(20240301).integers(1, 1 << 63, 64, dtype=np.uint64) * _U(2) + _U(1)
_STEP = 1 << 20  # powers that are kept
_LONG = 1 << 22  # longer ranges are summed in pieces, so that no sum passes 64 bits

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
BLANKS = np.zeros(256, bool)
BLANKS[[0x20, *range(0x09, 0x0E)]] = True
#: Every ASCII byte that is not a letter or digit.
SYMBOLS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def multiply(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo 2^61 - 1 of numbers below it."""
    a_low, a_high, b_low, b_high = a & _LOW, a >> _U(32), b & _LOW, b >> _U(32)
    middle, low = a_high * b_low + a_low * b_high, a_low * b_low
    total = (a_high * b_high << _U(3)) + (middle >> _U(29)) + ((middle & _29) << _U(32)) + (low & _P) + (low >> _U(61))
    return _reduced(total)


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & _P) + (x >> _U(61))
    return np.where(x >= _P, x - _P, x)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    while len(out) < n:
        out = np.concatenate([out, multiply(out, _U(pow(base, len(out), _PRIME)))])
    return out[:n]


_kept: dict[str, np.ndarray] = {}


def _table(name: str) -> np.ndarray:
    if name not in _kept:
        _kept[name] = {"up": lambda: _powers(_BASE, _STEP), "down": lambda: _powers(_INVERSE, 1 << 12), "far down": lambda: _powers(pow(_INVERSE, 1 << 12, _PRIME), 1 << 12)}[name]()
    return _kept[name]


def _down(places: np.ndarray) -> np.ndarray:
    """Powers of the inverse of the base."""
    out = multiply(_table("far down")[places >> 12 & 0xFFF], _table("down")[places & 0xFFF])
    far = places >> 24
    if len(far) and far.max():
        names, which = np.unique(far, return_inverse=True)
        out = multiply(out, np.array([pow(_INVERSE, int(f) << 24, _PRIME) for f in names], np.uint64)[which])
    return out


def _sums(lower: np.ndarray) -> np.ndarray:
    """Running sums of byte times power, low and high half of the power apart, modulo 2^64."""
    out = np.zeros((2, len(lower) + 1), np.uint64)
    up = _table("up")
    for a in range(0, len(lower), _STEP):
        part = lower[a : a + _STEP].astype(np.uint64) + _U(1)
        powers = up[: len(part)] if not a else multiply(up[: len(part)], _U(pow(_BASE, a, _PRIME)))
        for row, half in zip(out, (powers & _LOW, powers >> _U(32))):
            np.cumsum(part * half, out=row[a + 1 : a + len(part) + 1])
            row[a + 1 : a + len(part) + 1] += row[a]
    return out


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(29))) * _U(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> _U(32))


class Words(NamedTuple):
    hashes: np.ndarray  # of every word
    offsets: np.ndarray  # of each text's words, one more than texts
    starts: np.ndarray  # first byte of a word
    ends: np.ndarray  # one past its last byte
    prefix: np.ndarray  # prefix[:, i]: running sums of the bytes before i
    lower: np.ndarray


def rolling(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of any byte ranges, from the running sums: a polynomial modulo 2^61 - 1, then mixed one to one."""
    low, high = prefix[0][ends] - prefix[0][starts], prefix[1][ends] - prefix[1][starts]
    value = _reduced(_reduced(low) + multiply(_reduced(high), _U(1 << 32)))
    for i in np.flatnonzero(ends - starts > _LONG):
        cuts = np.append(np.arange(starts[i], ends[i], _LONG), ends[i])
        low, high = prefix[0][cuts[1:]] - prefix[0][cuts[:-1]], prefix[1][cuts[1:]] - prefix[1][cuts[:-1]]
        value[i] = sum(int(a) + (int(b) << 32) for a, b in zip(low, high)) % _PRIME
    return mix(multiply(value, _down(starts)))


def words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = BLANKS, fold: bool = True) -> Words:
    """Split texts at separator bytes, A-Z in lower case; no word crosses the end of a text."""
    lower = LOWER[data] if fold else data
    inside = ~separators[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before[edges] = False
    after[edges - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    prefix = _sums(lower)
    return Words(rolling(prefix, starts, ends), np.searchsorted(starts, offsets), starts, ends, prefix, lower)


def shingles(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``k`` consecutive words and each text's offsets; fewer words make one shingle, none make none."""
    n = np.diff(w.offsets)
    count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    offsets = np.concatenate([[0], np.cumsum(count)])
    first = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - w.offsets[:-1], count)
    last = np.repeat(w.offsets[1:], count)
    total = np.zeros(len(first), np.uint64)
    size = np.minimum(last - first, k)
    for j in range(k):
        at = first + j
        inside = at < last
        at = np.minimum(at, max(len(w.hashes) - 1, 0))
        total += np.where(inside, w.hashes[at] * _PLACE[j], _U(0)) if len(at) else _U(0)
    return mix(total + size.astype(np.uint64)), offsets


def distinct_per_text(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's hashes sorted and without repeats."""
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.lexsort((hashes, owner))
    h, o = hashes[order], owner[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    h, o = h[first], o[first]
    return h, np.searchsorted(o, np.arange(len(offsets)))
