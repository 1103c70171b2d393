"""Words, hashes and windows of Arrow text columns, computed with numpy over the raw UTF-8 bytes.

A word is a run of characters other than the ASCII white space U+0020 and U+0009 to U+000D, which is what
``bytes.split()`` yields. Hashes are 64 bits wide and depend on nothing but the bytes, so tasks agree on them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Text that one step of a task looks at; a longer text forms a step of its own.
STEP_BYTES = 2 << 20

WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True

_random = np.random.Generator(np.random.PCG64(20240501))
BYTE_KEYS = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BYTE_KEYS[WHITE] = 0
LOWER_KEYS = BYTE_KEYS.copy()
LOWER_KEYS[65:91] = BYTE_KEYS[97:123]
BASE = np.uint64(0x9E3779B97F4A7C15)
SHINGLE_BASE = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that all bits depend on all bits."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def text_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null is an empty text."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    raw = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def steps(batch: pa.RecordBatch, column: str, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose texts take ``limit`` bytes at most, one row at least."""
    if not batch.num_rows:
        return
    _, offsets = text_parts(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


@dataclass
class Words:
    """Words of several texts. ``first[d]:first[d + 1]`` are those of text ``d``."""

    raw: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, keys: np.ndarray = BYTE_KEYS) -> np.ndarray:
        """One 64-bit hash a word; ``LOWER_KEYS`` ignores the case of A to Z."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        lengths = self.ends - self.starts
        power = powers(BASE, int(lengths.max()))
        gaps = np.diff(self.starts, append=len(self.raw))
        place = np.arange(self.starts[0], len(self.raw)) - np.repeat(self.starts, gaps)
        np.minimum(place, len(power) - 1, out=place)  # white space after a word, whose key is 0
        values = keys[self.raw[self.starts[0] :]] * power[place]
        return mix(np.add.reduceat(values, self.starts - self.starts[0]) ^ (lengths.astype(np.uint64) << np.uint64(40)))


def words_of(column: pa.Array) -> Words:
    raw, offsets = text_parts(column)
    solid = ~WHITE[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    opens, closes = solid.copy(), solid.copy()
    opens[1:] &= ~solid[:-1] | edge[1:-1]
    closes[:-1] &= ~solid[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return Words(raw, starts, ends, np.searchsorted(starts, offsets))


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` values of ``hashes``, texts not told apart; order within a run counts."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    if size <= 8:
        total = np.zeros(n, np.uint64)
        for k in range(size):
            total *= SHINGLE_BASE
            total += hashes[k : k + n]
        return mix(total)
    power = powers(SHINGLE_BASE, len(hashes))
    inverse = powers(np.uint64(pow(int(SHINGLE_BASE), -1, 1 << 64)), n)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * power)])
    return mix((sums[size:] - sums[:-size]) * inverse)


def window_owner(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the runs of ``size`` words that lie within one text, and the text of each."""
    counts = np.maximum(np.diff(first) - size + 1, 0)
    text = np.repeat(np.arange(len(counts)), counts)
    begin = np.cumsum(counts) - counts
    return np.arange(counts.sum()) - begin[text] + first[text], text


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)
