"""Words, and 64-bit hashes of words and word windows, for many texts at once in numpy.

Hashes are polynomials over bytes (words) or word hashes (windows), read off prefix sums modulo 2 ** 64 and then
mixed. Two hashes with different constants name a word sequence among any number of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np

U = np.uint64
#: Odd multipliers of the splitmix and murmur mixers, and this module's own bases.
_GOLDEN, _MIX_A, _MIX_B = 0x9E3779B97F4A7C15, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53
_BASES = ((0xD6E8FEB86659FD93, 0xA0761D6478BD642F), (0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3))

#: ASCII white space parts words.
BLANKS = b" \t\n\v\f\r"
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_IS_WORD = np.array([b not in BLANKS for b in range(256)])


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a hash over all 64."""
    h = h ^ (h >> U(33))
    h = h * U(_MIX_A)
    h ^= h >> U(33)
    h *= U(_MIX_B)
    h ^= h >> U(33)
    return h


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base ** i and its inverse modulo 2 ** 64, for i below n at least."""
    found = _POWERS.get(base)
    if found is None or len(found[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        inverse = pow(base, -1, 1 << 64)
        tables = []
        for b in (base, inverse):
            steps = np.full(size, b, U)
            steps[0] = 1
            tables.append(np.cumprod(steps, dtype=U))
        found = (tables[0], tables[1])
        if n <= 1 << 21:
            _POWERS[base] = found
    return found


_TABLES = [mix((np.arange(1, 257, dtype=U) + U(1000 * k)) * U(_GOLDEN)) for k in range(2)]


class Words(NamedTuple):
    """The words of several texts: bytes, each word's start and end, and each text's first word (one more entry)."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray


def split_words(texts: Sequence[bytes | None], lower: bool = False) -> Words:
    """Runs of bytes other than ASCII white space; lower: with A-Z as a-z. None has no words."""
    joined = b" ".join([t or b"" for t in texts] + [b""])
    if lower:
        joined = joined.translate(LOWER)
    data = np.frombuffer(b" " + joined + b" ", np.uint8)
    inside = _IS_WORD[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[0::2], edges[1::2]
    sizes = np.fromiter((len(t) + 1 if t else 1 for t in texts), np.int64, len(texts))
    at = np.concatenate(([0], np.cumsum(sizes)))
    return Words(data[1:], starts, ends, np.searchsorted(starts, at))


def word_hashes(words: Words, which: int = 0) -> np.ndarray:
    powers, inverses = _powers(_BASES[which][0], len(words.data))
    sums = np.empty(len(words.data) + 1, U)
    sums[0] = 0
    terms = _TABLES[which][words.data]
    terms *= powers[: len(terms)]
    np.cumsum(terms, out=sums[1:])
    h = (sums[words.ends] - sums[words.starts]) * inverses[words.starts]
    return mix(h + (words.ends - words.starts).astype(U) * U(_GOLDEN))


def window_hashes(hashes: np.ndarray, bounds: np.ndarray, size: int, which: int = 0, short: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of every window of `size` words inside one text.

    short: a text of fewer words, but not none, gives one window of them all.
    """
    powers, inverses = _powers(_BASES[which][1], len(hashes) + 1)
    sums = np.empty(len(hashes) + 1, U)
    sums[0] = 0
    np.cumsum(hashes * powers[: len(hashes)], out=sums[1:])
    counts = np.diff(bounds)
    text = np.repeat(np.arange(len(counts)), counts)
    n = len(hashes) - size + 1
    starts = np.flatnonzero(text[:n] == text[size - 1 :]) if n > 0 else np.zeros(0, np.int64)
    lengths = np.full(len(starts), size)
    if short:
        few = np.flatnonzero((counts > 0) & (counts < size))
        starts = np.concatenate((starts, bounds[few]))
        lengths = np.concatenate((lengths, counts[few]))
        order = np.argsort(starts, kind="stable")
        starts, lengths = starts[order], lengths[order]
    h = (sums[starts + lengths] - sums[starts]) * inverses[starts]
    return starts, mix(h + lengths.astype(U) * U(_MIX_A))
