"""Words of Arrow text columns as numpy arrays, for the Python stages of this package.

A word is a longest run of bytes outside 0x20 and 0x09-0x0D. Words are found and hashed for a slice of
rows at once, so no Python loop runs per word. A slice holds about ``SLICE_BYTES`` of text (at least one
row), which bounds a task's memory by that and by its longest row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

_byte = np.arange(256)
GAP = (_byte == 0x20) | ((_byte >= 0x09) & (_byte <= 0x0D))
STARTS_CODE_POINT = (_byte & 0xC0) != 0x80
_plain = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_folded = _plain.copy()
_folded[65:91] = _plain[97:123]
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(h: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


def _powers_to(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers


class Slice:
    """The texts of some rows: bytes, row bounds, and words by place and row. NULL counts as empty."""

    def __init__(self, texts: pa.Array):
        texts = texts.cast(pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        whole = texts.buffers()[2]
        self.bytes = np.frombuffer(whole, np.uint8)[offsets[0] : offsets[-1]] if whole else np.zeros(0, np.uint8)
        self.bounds = offsets - offsets[0]
        self.rows = len(texts)
        inside = ~GAP[self.bytes]
        before, after = np.ones(len(inside) + 1, bool), np.ones(len(inside) + 1, bool)
        before[1:-1] = ~inside[:-1]
        before[self.bounds] = True
        after[:-1] = before[1:]
        after[:-2] |= ~inside[1:] if len(inside) > 1 else after[:-2]
        self.starts = np.flatnonzero(inside & before[:-1])
        self.ends = np.flatnonzero(inside & after[:-1]) + 1
        self.row = np.searchsorted(self.bounds, self.starts, "right") - 1
        self.n_words = np.bincount(self.row, minlength=self.rows).astype(np.int64)
        self.first_word = np.concatenate([[0], np.cumsum(self.n_words)])

    def hashes(self, fold_case: bool) -> np.ndarray:
        """A 64-bit hash of each word; ``fold_case`` takes A-Z as a-z."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        powers, inverses = _powers_to(len(self.bytes) + 1)
        sums = np.zeros(len(self.bytes) + 1, np.uint64)
        np.cumsum((_folded if fold_case else _plain)[self.bytes] * powers[: len(self.bytes)], out=sums[1:])
        return mix((sums[self.ends] - sums[self.starts]) * inverses[self.starts])

    def per_row(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes of each row have the flag."""
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return sums[self.bounds[1:]] - sums[self.bounds[:-1]]

    def word(self, i: int) -> bytes:
        return self.bytes[self.starts[i] : self.ends[i]].tobytes()


def windows(words: Slice, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words inside a row, and the index of each run's first word."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    inside = np.flatnonzero(words.row[:n] == words.row[size - 1 :])
    h = np.full(len(inside), size, np.uint64)
    for k in range(size):
        h = mix(h * _BASE + hashes[inside + k])
    return h, inside


def slices(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[tuple[pa.RecordBatch, Slice]]:
    """Cut Arrow batches into runs of rows of about ``SLICE_BYTES`` of text, each with its words."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text)).cast(pa.large_binary())
        if not len(column):
            continue
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        at = 0
        while at < len(column):
            stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, "right")) - 1)
            yield batch.slice(at, stop - at), Slice(column.slice(at, stop - at))
            at = stop


def signed(h: np.ndarray) -> pa.Array:
    """Unsigned 64-bit hashes as Spark's signed longs."""
    return pa.array(h.view(np.int64))
