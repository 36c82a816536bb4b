"""Word shingles of whole texts as 64-bit hashes, vectorised over a batch.

Texts are handled as UTF-8 bytes: the separators (space, tab, LF, VT, FF, CR)
and the letters A-Z that are lower-cased are single bytes in UTF-8, so byte
work gives the same words as code-point work.

A word's hash is a sum over its bytes of ``T[byte] * M**i`` (mod 2**64), a
shingle's hash a sum over its words of ``mix(word) * K**j``.  Both are taken
for the whole batch at once.  Two different shingles of one corpus share a
64-bit value with probability about ``pairs / 2**64``; see the README.
"""

from __future__ import annotations

import numpy as np

WIDTH = 5

_U = np.uint64


def mix64(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """The splitmix64 finaliser: a bijection that spreads all bits."""
    with np.errstate(over="ignore"):
        x = x + _U((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


_TABLE = mix64(np.arange(256, dtype=_U), 7)
_TABLE[65:91] = _TABLE[97:123]  # A-Z count as a-z
_IS_SEP = np.zeros(256, dtype=bool)
_IS_SEP[[32, 9, 10, 11, 12, 13]] = True
_M = 0xD1342543DE82EF95
_K = [pow(0xA0761D6478BD642F | 1, j + 1, 1 << 64) for j in range(WIDTH)]
_POWERS = np.ones(64, dtype=_U)
for _i in range(1, 64):
    _POWERS[_i] = (int(_POWERS[_i - 1]) * _M) & 0xFFFFFFFFFFFFFFFF


def _powers(n: int) -> np.ndarray:
    """M**0 .. M**(n-1) (the table grows to the longest word seen)."""
    global _POWERS
    while len(_POWERS) < n:
        step = _U(pow(_M, len(_POWERS), 1 << 64))
        _POWERS = np.concatenate([_POWERS, _POWERS * step])
    return _POWERS


def word_hashes(buf: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of the concatenated texts ``buf`` and, per text, the
    index of its first word (``len(bounds)`` entries, the last one is the
    number of words).  ``bounds`` are the texts' byte offsets."""
    n = len(buf)
    if n == 0:
        return np.empty(0, _U), np.zeros(len(bounds), np.int64)
    inside = ~_IS_SEP[buf]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = bounds[:-1][bounds[:-1] < n]
    first[cuts] |= inside[cuts]  # a word never runs on into the next text
    pos = np.flatnonzero(inside)
    starts = np.flatnonzero(first)
    if len(starts) == 0:
        return np.empty(0, _U), np.zeros(len(bounds), np.int64)
    at = np.flatnonzero(first[pos])  # where each word starts within pos
    lens = np.diff(np.append(at, len(pos)))
    offset = np.arange(len(pos), dtype=np.int64) - np.repeat(at, lens)
    vals = _TABLE[buf[pos]] * _powers(int(lens.max()))[offset]
    words = mix64(np.add.reduceat(vals, at) + lens.astype(_U), 1)
    return words, np.searchsorted(starts, bounds)


def shingle_sets(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every text, concatenated, and the
    ``len(texts) + 1`` offsets.  Fewer words than WIDTH: the whole sequence
    is one shingle.  No words, or null: the empty set."""
    raw = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
    bounds = np.zeros(len(raw) + 1, np.int64)
    np.cumsum([len(r) for r in raw], out=bounds[1:])
    words, first = word_hashes(np.frombuffer(b"".join(raw), np.uint8), bounds)
    n_words = np.diff(first)
    n_sh = np.where(n_words >= WIDTH, n_words - WIDTH + 1, np.minimum(n_words, 1))
    offs = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(n_sh, out=offs[1:])
    doc = np.repeat(np.arange(len(raw)), n_sh)
    at = first[:-1][doc] + (np.arange(offs[-1]) - offs[:-1][doc])
    end = first[1:][doc]
    h = np.zeros(len(doc), _U)
    padded = np.append(words, np.zeros(WIDTH, _U))
    for j in range(WIDTH):
        idx = at + j
        h += np.where(idx < end, padded[idx], _U(0)) * _U(_K[j])
    h = mix64(h, 2)
    for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True):
        h[a:b].sort()
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[keep], doc[keep]
    out = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(np.bincount(doc, minlength=len(raw)), out=out[1:])
    return h, out
