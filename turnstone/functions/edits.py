"""Edit operations and distances between token sequences and texts."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of kept columns up to which an alignment goes back without making any again.
HELD_BYTES = 1 << 26
#: Bytes of the tokens' places as whole numbers; beyond, a column's places are put together where they are needed.
MASK_BYTES = 1 << 26

KINDS = ("match", "substitution", "deletion", "insertion")
_MATCH, _SUBSTITUTION, _DELETION, _INSERTION = range(4)


def _codes(reference, hypothesis) -> tuple[list[int], list[int]]:
    names: dict[str, int] = {}
    number = lambda tokens: [names.setdefault(t, len(names)) for t in tokens]
    return number(reference), number(hypothesis)


def banded_distance(x: list[int], y: list[int], reach: int | None = None) -> int:
    m, n = len(x), len(y)
    reach = max(abs(m - n) + 1, reach or max(32, (m + n) // 24))
    while True:
        band = _Band(x, y, reach)
        corner = m - n + reach
        found = max(m - n, 0) + sum(not zero >> corner & 1 for zero, _, _ in band.columns(1, n, band.start()))
        if found <= reach or reach >= max(m, n):
            return found
        reach = min(max(m, n), 2 * reach)


class _Band:
    """A band of the distance table of tokens x and y, a column (a token of y) at a time: rows at most `reach` off the
    diagonal, as the bits of whole numbers, the lowest bit the highest row. Bit b of column j stands for row j + b - reach.

    A column is told by the differences between neighbours: zero has the cells that equal the one diagonally before, plus and minus the
    cells that are one more or less than the one above; plus and minus are kept as the next column counts its rows.
    If the last cell is at most `reach`, every cell on a least-cost path is inside and exact.
    """

    def __init__(self, x: list[int], y: list[int], reach: int):
        self.y, self.reach = y, reach
        self.width = 2 * reach + 1
        self.mask = (1 << self.width) - 1
        places: dict[int, list[int]] = {}
        for i, code in enumerate(x):
            places.setdefault(code, []).append(i)
        self.places = {code: np.array(at) for code, at in places.items()}
        self.whole = {code: _bits(at, len(x)) for code, at in self.places.items()} if len(places) * len(x) <= MASK_BYTES * 8 else None

    def _equal(self, j: int) -> int:
        """The rows of column j whose token is the column's."""
        first = j - self.reach - 1  # the token of bit 0
        if self.whole is not None:
            whole = self.whole.get(self.y[j - 1], 0)
            return (whole >> first if first >= 0 else whole << -first) & self.mask
        at = self.places.get(self.y[j - 1])
        if at is None:
            return 0
        low, high = np.searchsorted(at, (first, first + self.width))
        return _bits(at[low:high] - first, self.width)

    def start(self) -> tuple[int, int]:
        return self.mask ^ ((1 << self.reach) - 1), 0

    def columns(self, first: int, last: int, state: tuple[int, int]):
        """(zero, plus, minus) of columns first to last, from the state before them."""
        mask = self.mask
        plus, minus = state
        for j in range(first, last + 1):
            equal = self._equal(j) | minus
            zero = ((((equal & plus) + plus) ^ plus) | equal) & mask
            up = minus | (mask ^ (zero | plus))
            down, shifted = zero & plus, zero >> 1
            plus, minus = down | (mask ^ (shifted | up)), shifted & up
            yield zero, plus, minus


def _bits(places: np.ndarray, size: int) -> int:
    if len(places) <= 4:
        found = 0
        for p in places.tolist():
            found |= 1 << p
        return found
    held = np.zeros(size, np.uint8)
    held[places] = 1
    return int.from_bytes(np.packbits(held, bitorder="little").tobytes(), "little")


def align(reference, hypothesis, reach: int | None = None, held: int = HELD_BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A least-cost alignment as kinds (places in KINDS), reference and hypothesis places (-1: none), in order.

    Going back from the end a diagonal step is preferred, then a deletion. Only a band of the table around its diagonal
    is made, doubled until the distance fits into it, so time grows with length times errors, a machine word of rows at
    once. Going back needs the columns again: they are kept, or, above `held` bytes, one in some is, and a block made again from it.
    """
    x, y = _codes(reference, hypothesis)
    tail = 0
    while tail < min(len(x), len(y)) and x[-1 - tail] == y[-1 - tail]:
        tail += 1  # at the end equal tokens are always a diagonal step
    m, n = len(x) - tail, len(y) - tail
    x, y = x[:m], y[:n]
    reach = max(abs(m - n) + 1, reach or max(32, (m + n) // 24))
    while True:
        band = _Band(x, y, reach)
        every = max(1, -(-n * band.width // (4 * held)))
        step = n + 1 if every == 1 else max(1, int(n**0.5))
        kept, states = [(0, 0)], {0: band.start()}
        distance, corner = max(m - n, 0), m - n + reach
        for j, (zero, plus, minus) in enumerate(band.columns(1, n, states[0]), 1):
            distance += not zero >> corner & 1
            if every == 1:
                kept.append((zero, plus))
            elif j % step == 0:
                states[j] = (plus, minus)
        if distance <= reach or reach >= max(m, n):
            break
        reach = min(max(m, n), 2 * reach)
    kinds, rows, columns = [_MATCH] * tail, list(range(m + tail - 1, m - 1, -1)), list(range(n + tail - 1, n - 1, -1))
    i, j, low = m, n, 0 if every == 1 else n + 1
    while i or j:
        if 0 < j <= low:  # the block before
            low = (j - 1) // step * step
            kept = [(0, 0), *((zero, plus) for zero, plus, _ in band.columns(low + 1, j, states[low]))]
        if i and j:
            if x[i - 1] == y[j - 1]:
                kind = _MATCH
            else:
                zero, plus = kept[j - low]
                bit = i - j + reach
                kind = _SUBSTITUTION if not zero >> bit & 1 else _DELETION if bit and plus >> (bit - 1) & 1 else _INSERTION
        else:
            kind = _DELETION if i else _INSERTION
        i, j = i - (kind != _INSERTION), j - (kind != _DELETION)
        kinds.append(kind)
        rows.append(-1 if kind == _INSERTION else i)
        columns.append(-1 if kind == _DELETION else j)
    return np.array(kinds[::-1], np.int8), np.array(rows[::-1], np.int32), np.array(columns[::-1], np.int32)


def alignment(reference, hypothesis) -> list[tuple[str, int | None, int | None]]:
    """`align` as (kind, reference place, hypothesis place)."""
    own = lambda p: None if p < 0 else p
    return [(KINDS[k], own(i), own(j)) for k, i, j in zip(*(a.tolist() for a in align(reference, hypothesis)), strict=True)]


#: Texts up to so many characters are compared with whole columns of the table, longer ones in a band of it.
SHORT_TEXT = 4096


def text_distance(a: str, b: str) -> int:
    """Edit distance of two texts, a column of the table at a time as the bits of whole numbers (vertical differences,
    plus and minus one), so a column of any height is a few operations; of long texts only a band, as `align` has."""
    n = next((k for k in range(1, min(len(a), len(b)) + 1) if a[-k] != b[-k]), min(len(a), len(b)) + 1) - 1
    a, b = a[: len(a) - n], b[: len(b) - n]
    if not a or not b:
        return len(a) + len(b)
    if max(len(a), len(b)) > SHORT_TEXT:
        return banded_distance([ord(c) for c in a], [ord(c) for c in b])
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    every, last = (1 << len(a)) - 1, len(a) - 1
    plus, minus, found = every, 0, len(a)
    for c in b:
        equal = places.get(c, 0)
        keeps = equal | minus
        zero = (((equal & plus) + plus) ^ plus) | equal
        up, down = minus | (every & ~(zero | plus)), plus & zero
        found += (up >> last & 1) - (down >> last & 1)
        up, down = (up << 1 | 1) & every, (down << 1) & every
        plus, minus = down | (every & ~(keeps | up)), up & keeps
    return found


@F.pandas_udf(T.LongType())
def char_distance(a: pd.Series, b: pd.Series) -> pd.Series:
    """Edit distance of two texts, whatever their lengths."""
    return pd.Series([None if x is None or y is None else text_distance(x, y) for x, y in zip(a, b, strict=True)], dtype="Int64")
