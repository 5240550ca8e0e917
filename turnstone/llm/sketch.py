"""Count-min sketches of 64-bit hashes, of any width: each chunk of texts asks, shards merge and answer with bits.

Nothing of a sketch passes the driver or is broadcast, and no task holds more than a shard.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from turnstone.llm.arrow import release
from turnstone.llm.hashing import U, mix

#: Chunks grow beyond so many of them, and so do shards.
MAX_CHUNKS = 2_000_000
MAX_SHARDS = 65_536
#: Cells of a shard, a byte each in the task that merges it.
SHARD_CELLS = 1 << 24
#: Beyond so many bytes of text, chunks and shards both grow with the square root of the corpus, so that what a chunk sends
#: to a shard holds as many hashes at any size, and the rows sent grow with the corpus. They grow up to so many times.
STEADY_BYTES = 30_000_000_000
MAX_GROWTH = 20.0

_SALTS = [U(0x9E3779B97F4A7C15), U(0xD1B54A32D192ED03)]
_ASKED = pa.schema([("chunk", pa.int64()), ("row", pa.int32()), ("shard", pa.int32()), ("payload", pa.binary())])


def pack(cells: np.ndarray, unit: type = np.uint8) -> bytes:
    """Sorted cells as units of gaps; the largest unit adds itself to the gap that follows."""
    most = np.iinfo(unit).max
    gaps = np.diff(cells, prepend=cells.dtype.type(0)).astype(np.int64)
    more, last = np.divmod(gaps, most)
    ends = np.cumsum(more + 1) - 1
    out = np.full(int(ends[-1]) + 1, most, unit)
    out[ends] = last
    return out.tobytes()


def unpack(payload: bytes, unit: type = np.uint8) -> np.ndarray:
    gaps = np.frombuffer(payload, unit)
    return np.cumsum(gaps, dtype=np.int64)[gaps != np.iinfo(unit).max]


class Layout:
    """How a corpus is dealt into chunks, and the sketch of its hashes into shards, both in proportion to its bytes.

    total: bytes of text; chunk: bytes of a chunk, about; cells: a byte of text; each: cells a hash, about; levels:
    the counts (under 256) that are told apart.
    """

    def __init__(self, total: int, chunk: int, cells: float, each: float, rows: int, levels: tuple[int, ...]):
        self.rows, self.levels = rows, levels
        growth = min(MAX_GROWTH, max(1.0, (total / STEADY_BYTES) ** 0.5))
        self.chunks = max(1, min(MAX_CHUNKS, -(-total // int(chunk * growth))))
        self.width = max(SHARD_CELLS, int(total * cells))
        self.shard = max(int(SHARD_CELLS * growth), -(-self.width // MAX_SHARDS))
        gap = self.width / max(1.0, total * cells / each / self.chunks)
        self.unit = np.uint8 if gap < 100 else np.uint16 if gap < 20_000 else np.uint32

    def cells(self, hashes: np.ndarray, row: int) -> np.ndarray:
        return mix(hashes + _SALTS[row]) % U(self.width)

    def fresh(self, cells: np.ndarray) -> np.ndarray:
        """Which of sorted cells are sent: each one as often as the highest level asks for."""
        most = max(self.levels)
        found = np.ones(len(cells), bool)
        found[most:] = cells[most:] != cells[:-most]
        return found

    def cuts(self, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The shards that sorted cells fall into, and where each one's begin (one more entry)."""
        every = np.arange(-(-self.width // self.shard) + 1, dtype=U) * U(self.shard)
        at = np.searchsorted(cells, every)
        full = np.flatnonzero(at[1:] > at[:-1])
        return full, np.concatenate((at[full], at[-1:]))


def _question(layout: Layout, chunk: int, hashes: np.ndarray) -> pa.Table:
    """A chunk's part of the sketch: its hashes' cells, sorted and packed, by row and shard."""
    out = []
    for row in range(layout.rows):
        cells = np.sort(layout.cells(hashes, row))
        cells = cells[layout.fresh(cells)]
        full, at = layout.cuts(cells)
        out += [{"chunk": chunk, "row": row, "shard": s, "payload": pack(cells[a:b] - U(int(s) * layout.shard), layout.unit)} for s, a, b in zip(full.tolist(), at[:-1], at[1:], strict=True)]
    return pa.Table.from_pylist(out, _ASKED)


def _answer(layout: Layout, table: pa.Table) -> pa.Table:
    """Merges a shard: adds up all chunks' cells, and tells each chunk, a bit a cell and level, which have reached it."""
    counts, most = np.zeros(layout.shard, np.uint8), max(layout.levels)
    for payload in table["payload"]:
        own, times = np.unique(unpack(payload.as_buffer(), layout.unit), return_counts=True)
        counts[own] = np.minimum(counts[own] + times, most)
    bits = []
    for payload in table["payload"]:
        found = counts[unpack(payload.as_buffer(), layout.unit)]
        bits.append(b"".join(np.packbits(found >= level).tobytes() for level in layout.levels))
    return pa.table({"chunk": table["chunk"], "row": table["row"], "shard": table["shard"], "bits": pa.array(bits, pa.binary())})


def answers(dealt: DataFrame, layout: Layout, hashes_of: Callable[[pa.Table], np.ndarray]) -> DataFrame:
    """chunk, row, shard, bits: what each chunk of dealt (chunk, and what hashes_of reads) may know of its hashes."""

    def ask(table: pa.Table) -> pa.Table:
        asked = _question(layout, table["chunk"][0].as_py(), hashes_of(table))
        release()
        return asked

    asked = dealt.groupBy("chunk").applyInArrow(ask, "chunk long, row int, shard int, payload binary")
    return asked.groupBy("row", "shard").applyInArrow(lambda table: _answer(layout, table), "chunk long, row int, shard int, bits binary")


def at_least(layout: Layout, hashes: np.ndarray, side: pa.Table) -> list[np.ndarray]:
    """For each level, whether each of a chunk's hashes may have been counted so often; False is certain.

    side: the chunk's answers; rows without `row` are others.
    """
    known = {(row, shard): bits.as_buffer() for row, shard, bits in zip(side["row"].to_pylist(), side["shard"].to_pylist(), side["bits"], strict=True) if row is not None}
    found = [np.ones(len(hashes), bool) for _ in layout.levels]
    if not len(hashes):
        return found
    for row in range(layout.rows):
        cells = layout.cells(hashes, row)
        order = np.argsort(cells, kind="stable")
        fresh = layout.fresh(cells[order])
        full, at = layout.cuts(cells[order][fresh])
        parts: list[list[np.ndarray]] = [[] for _ in layout.levels]
        for shard, n in zip(full.tolist(), np.diff(at).tolist(), strict=True):
            for part, bits in zip(parts, np.frombuffer(known[row, shard], np.uint8).reshape(len(layout.levels), -1), strict=True):
                part.append(np.unpackbits(bits, count=n))
        place = np.cumsum(fresh) - 1
        for mask, part in zip(found, parts, strict=True):
            mask[order] &= np.concatenate(part).astype(bool)[place]
    return found
