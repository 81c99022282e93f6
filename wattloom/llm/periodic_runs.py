"""Runs of repeated words: maximal stretches with a small period, found on a harmonic grid of longest common extensions.

A run is a stretch of consecutive words with smallest period q (words q apart are equal) that no neighbouring word extends, of ``least`` words
and ``exponent`` periods or more.

**Harmonic grid.** In a run of period q, words q apart agree at ``step = max((exponent - 1) q, least - q)`` consecutive places or more, so
one of the places 0, step, 2 step, ... is among them. For each q only those n / step places are tried, n log n in all. Where the words at
i and i + q are equal, the common extensions forwards and backwards give the whole run. A stretch met with several periods keeps the
smallest: the others are its multiples.

**Extensions by a difference cover.** Only suffixes that start at places in ``COVER`` modulo ``MODULUS`` are sorted: first by their first
``MODULUS`` words, then by doubling over samples. For any two places some shift under ``MODULUS`` brings both to sampled places, so an extension
compares that few words and takes the rest as a range minimum, from a sparse table over the common prefixes of neighbours in suffix order.
Most pairs differ within the compared words; suffixes are sorted for the texts where some pair does not.
Backward extensions are forward ones in the reversed texts. A whole slice of texts is one array, with a mark of its own after each text.

Defined results: NULL, empty and blank texts have no words and no runs; rows with equal ids are separate rows; columns other
than the id and the text are not read. Words are compared by 64-bit hashes, in their own case. A text is worked on whole by one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.text import Slice, slices

MODULUS, COVER = 31, (1, 5, 11, 24, 25, 27)  # every difference modulo 31 is one of two members
_GRID = 2_000_000  # grid places tried at once

_member = np.full(MODULUS, -1)
_member[list(COVER)] = np.arange(len(COVER))
#: the shift by which places i and i + d both become sampled, by i and d modulo MODULUS
SHIFT = np.array([[next(s for s in range(MODULUS) if _member[(i + s) % MODULUS] >= 0 <= _member[(i + d + s) % MODULUS]) for d in range(MODULUS)] for i in range(MODULUS)])


def compared(words: np.ndarray, i: np.ndarray, j: np.ndarray, most: int) -> np.ndarray:
    """How many words agree from places ``i`` and ``j`` on, at most ``most``, by looking at them."""
    length, going = np.zeros(len(i), np.int64), np.arange(len(i))
    for k in range(most):
        going = going[words[i[going] + k] == words[j[going] + k]]
        if not len(going):
            break
        length[going] += 1
    return length


class SampledSuffixes:
    """Common extensions in ``words``, which end in a value found nowhere else."""

    def __init__(self, words: np.ndarray):
        symbols = np.unique(words, return_inverse=True)[1] + 1
        place = (np.arange(len(words) // MODULUS + 1)[:, None] * MODULUS + np.array(COVER)).ravel()
        place = place[place < len(words)]
        ranks = [self._by_first_words(symbols, place)]
        while len(place) and ranks[-1].max() < len(place):
            later = len(COVER) << (len(ranks) - 1)  # the sample as many words on as are ranked
            follower = np.zeros(len(place), np.int64)
            follower[: max(0, len(place) - later)] = ranks[-1][later:]
            ranks.append(np.unique(ranks[-1] * (len(place) + 1) + follower, return_inverse=True)[1] + 1)
        self.rank = ranks[-1] - 1
        order = np.argsort(self.rank)
        common = self._common_prefixes(symbols, place, ranks, order[:-1], order[1:])
        self.minima = [common]
        while len(self.minima[-1]) > 1 << (len(self.minima) - 1):
            half = 1 << (len(self.minima) - 1)
            self.minima.append(np.minimum(self.minima[-1][:-half], self.minima[-1][half:]))

    @staticmethod
    def _by_first_words(symbols: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Ranks from 1 by the first ``MODULUS`` words."""
        padded = np.concatenate([symbols, np.zeros(2 * MODULUS, symbols.dtype)])
        bits = max(1, int(symbols.max(initial=1)).bit_length())
        per_key = max(1, 62 // bits)
        keys = []
        for a in range(0, MODULUS, per_key):
            key = np.zeros(len(place), np.int64)
            for k in range(a, min(a + per_key, MODULUS)):
                key = key << bits | padded[place + k]
            keys.append(key)
        order = np.lexsort(keys[::-1])
        new = np.ones(len(place), np.int64)
        for_order = [key[order] for key in keys]
        new[1:] = np.logical_or.reduce([key[1:] != key[:-1] for key in for_order])
        rank = np.empty(len(place), np.int64)
        rank[order] = np.cumsum(new)
        return rank

    @staticmethod
    def _common_prefixes(symbols: np.ndarray, place: np.ndarray, ranks: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that the suffixes of samples ``a`` and ``b`` share: whole ranked blocks, then word by word."""
        a, b, shared = a.copy(), b.copy(), np.zeros(len(a), np.int64)
        for level in range(len(ranks) - 1, -1, -1):
            inside = np.maximum(a, b) < len(place)
            same = inside.copy()
            same[inside] = ranks[level][a[inside]] == ranks[level][b[inside]]
            shared += same * (MODULUS << level)
            a, b = a + same * (len(COVER) << level), b + same * (len(COVER) << level)
        inside = np.flatnonzero(np.maximum(a, b) < len(place))
        padded = np.concatenate([symbols, np.zeros(MODULUS, symbols.dtype)])
        shared[inside] += compared(padded, place[a[inside]], place[b[inside]], MODULUS)
        return shared

    def extensions(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common extensions of places that are known to agree for ``MODULUS`` words."""
        shift = SHIFT[i % MODULUS, (j - i) % MODULUS]
        a, b = (self.rank[(p + shift) // MODULUS * len(COVER) + _member[(p + shift) % MODULUS]] for p in (i, j))
        low, high = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        rest = np.empty(len(i), np.int64)
        for k in np.unique(level):
            at = level == k
            rest[at] = np.minimum(self.minima[k][low[at]], self.minima[k][high[at] - (1 << int(k))])
        return shift + rest


def extensions(words: np.ndarray, text: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many words agree from ``i`` and ``j`` on. ``text`` numbers the texts along ``words``; each ends in a value found nowhere else."""
    length = compared(words, i, j, MODULUS)
    long = np.flatnonzero(length == MODULUS)
    if len(long):
        chosen = np.zeros(int(text.max()) + 1, bool)
        chosen[text[i[long]]] = True
        kept = chosen[text]
        to = np.cumsum(kept) - 1
        length[long] = SampledSuffixes(words[kept]).extensions(to[i[long]], to[j[long]])
    return length


def grid(n_words: np.ndarray, least: int, exponent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, place, period) of the places to try, in blocks."""
    most = np.where(n_words >= least, n_words // exponent, 0)
    ends = np.cumsum(most)
    for a in range(0, int(ends[-1]) if len(ends) else 0, _GRID):
        k = np.arange(a, min(a + _GRID, int(ends[-1])))
        text = np.searchsorted(ends, k, "right")
        period = k - (ends - most)[text] + 1
        step = np.maximum((exponent - 1) * period, least - period)
        tries = (n_words[text] - 1 - period) // step + 1
        total = np.cumsum(tries)
        begin = 0
        while begin < len(k):
            stop = max(begin + 1, int(np.searchsorted(total, (total[begin - 1] if begin else 0) + _GRID, "right")))
            part = slice(begin, stop)
            at = np.repeat(np.arange(begin, stop), tries[part])
            nth = np.arange(len(at)) - np.repeat(np.cumsum(tries[part]) - tries[part], tries[part])
            yield text[at], nth * step[at], period[at]
            begin = stop


def runs(hashes: np.ndarray, n_words: np.ndarray, least: int, exponent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of all runs of some texts, ordered by text, start and period."""
    n_texts = len(n_words)
    begin = np.cumsum(n_words + 1) - n_words  # a mark before the first text and after each
    words = np.arange(len(hashes) + n_texts + 1, dtype=np.uint64)  # marks are small numbers, as no hash is
    of = np.repeat(np.arange(n_texts), n_words)
    words[np.arange(len(hashes)) + of + 1] = hashes
    text = np.repeat(np.arange(n_texts), n_words + 1)
    forwards, backwards = np.concatenate([[0], text]), np.concatenate([text, [n_texts - 1]])[::-1]
    mirrored, last = words[::-1], len(words) - 1
    found = [np.zeros((4, 0), np.int64)]
    for row, place, period in grid(n_words, least, exponent):
        i = begin[row] + place
        same = words[i] == words[i + period]
        row, i, period = row[same], i[same], period[same]
        before = extensions(mirrored, backwards, last - i, last - i - period) - 1
        after = extensions(words, forwards, i, i + period)
        whole = before + after >= np.maximum((exponent - 1) * period, least - period)
        start = (i - before - begin[row])[whole]
        found.append(np.stack([row[whole], start, (before + after + period)[whole], period[whole]]))
    row, start, length, period = np.concatenate(found, axis=1)
    order = np.lexsort((period, length, start, row))
    row, start, length, period = (c[order] for c in (row, start, length, period))
    first = np.ones(len(row), bool)
    first[1:] = (row[1:] != row[:-1]) | (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    row, start, length, period = (c[first] for c in (row, start, length, period))
    order = np.lexsort((period, start, row))
    return tuple(c[order] for c in (row, start, length, period))


def repeated_words(n_words: np.ndarray, row: np.ndarray, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which words lie in a run after its first period."""
    base = (np.cumsum(n_words) - n_words)[row]
    change = np.zeros(int(n_words.sum()) + 1, np.int64)
    np.add.at(change, base + start + period, 1)
    np.add.at(change, base + start + length, -1)
    return np.cumsum(change)[:-1] > 0


def joined(words: Slice, keep: np.ndarray) -> pa.Array:
    """The kept words of each row, joined by one blank."""
    chosen = np.flatnonzero(keep)
    row = words.row[chosen]
    blank = np.zeros(len(chosen), np.int64)
    blank[:-1] = row[1:] == row[:-1]
    lengths = words.ends[chosen] - words.starts[chosen]
    after = np.cumsum(lengths + blank)
    out = np.full(int(after[-1]) if len(after) else 0, 0x20, np.uint8)
    owner = np.repeat(np.arange(len(chosen)), lengths)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[(after - lengths - blank)[owner] + within] = words.bytes[words.starts[chosen][owner] + within]
    bounds = np.zeros(words.rows + 1, np.int64)
    np.add.at(bounds, row + 1, lengths + blank)
    offsets = pa.py_buffer(np.cumsum(bounds).tobytes())
    return pa.Array.from_buffers(pa.large_string(), words.rows, [None, offsets, pa.py_buffer(out.tobytes())])


_RUN = pa.struct([pa.field(name, pa.int64()) for name in ("start", "length", "period")])


def find_runs(docs: DataFrame, least: int = 6, exponent: int = 4, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_words, runs, collapsed) of each row: its runs by start and period, and its words without what repeats a run's first period."""
    if exponent < 2 or least < 2:
        raise ValueError("a run has two periods and two words at least")

    def find(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, words in slices(parts):
            row, start, length, period = runs(words.hashes(fold_case=False), words.n_words, least, exponent)
            bounds = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=words.rows))])
            each = pa.StructArray.from_arrays([pa.array(c) for c in (start, length, period)], fields=list(_RUN))
            collapsed = joined(words, ~repeated_words(words.n_words, row, start, length, period))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(words.n_words), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), each), collapsed.cast(pa.string())],
                ["id", "n_words", "runs", "collapsed"],
            )

    narrow = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text).alias("text"))
    return narrow.mapInArrow(find, "id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")
