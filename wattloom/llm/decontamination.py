"""Benchmark decontamination by embedded edit distance.

Documents are searched for stretches within a bounded edit distance, in words, of a benchmark item: at most
``max_edits`` of its words inserted, deleted or replaced.

1. **Windows.** Items fall into length classes; a class of c words looks at windows of c words starting at every word of
   every document. An item whose first c words have p different pairs of neighbours can only be within d edits of a stretch
   of c + d words if p - 2d of the pairs are there, because an edit breaks two at most. Windows with fewer of the benchmark's
   pairs are left out; this loses nothing.
2. **Embedding.** A CGK random walk copies a word sequence to 3c symbols: step j writes the word under the pointer, which
   moves on if a random bit of (j, word) says so. Sequences at a small edit distance get embeddings at a small Hamming distance.
3. **Bit-sampling LSH.** Each repetition has its own walk and hashes a few sampled steps of it. Repetitions are as many as
   a simulation of d random edits needs to reach the target recall, and a second draw confirms. Walks drift apart along long
   sequences, so an item of more than ``LONGEST_PIECE`` words is indexed by equal pieces: of k pieces, one has at most d / k
   edits. Where ``MOST_REPETITIONS`` walks do not reach the target, every window with enough pairs is a candidate instead.
4. **Verification.** Each candidate (window, item) is aligned exactly over the whole item; only distances within the bound count.
   From a piece, the whole item's start is sought up to d words to either side of where the piece puts it.

The benchmark is the query set: it is taken in blocks of a bounded number of items, each block sent to the tasks and held
against all rows in one pass without a shuffle. Documents are never collected.

Defined results: NULL and empty texts match nothing; items without words are left out; items of equal text all match;
repeated rows each match; ``found`` lists each (document row, item) once, at its best place.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.text import Slice, mix, slices, windows

BLOCK_ITEMS, BLOCK_BYTES = 20_000, 16 << 20
SAMPLED = 3  # steps hashed in a repetition
MOST_REPETITIONS, TRIALS = 128, 300
LONGEST_PIECE = 104  # words; the pieces of longer items are of the same classes as shorter items
_PAD = np.uint64(0xA5A5A5A5A5A5A5A5)
_STEP, _WALK = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xCA5A826395121157)


def edit_bound(n_words: int, max_edits: float) -> int:
    return int(n_words * max_edits)


def length_class(n_words: int) -> int:
    """The largest of 1, 2, 3, 4, 5, 6, 8, 10, 12, 15 ... (steps of about a fifth) that is at most ``n_words``."""
    c = 1
    while (following := max(c + 1, c * 6 // 5)) <= n_words:
        c = following
    return c


def embed(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, walk: int, wanted: np.ndarray) -> np.ndarray:
    """One hash for each sequence ``hashes[start:end]``: the symbols of its walk at the ``wanted`` steps."""
    padded = np.append(hashes, _PAD)
    at, out = starts.copy(), np.full(len(starts), walk, np.uint64)
    seed = mix(np.full(1, walk, np.uint64) * _WALK)
    for j in range(int(wanted.max()) + 1):
        symbol = padded[np.where(at < ends, at, len(hashes))]
        for _ in range(int((wanted == j).sum())):
            out = mix(out * _STEP + symbol)
        at += (mix(symbol ^ mix(seed + np.uint64(j))) >> np.uint64(33)).astype(np.int64) & 1
    return out


def sampled_steps(c: int, walk: int) -> np.ndarray:
    """Steps to hash: among the first 3c / 2, where the pointer has hardly ever left the window (what follows is padding)."""
    return np.sort(np.random.default_rng((c, walk)).integers(0, 3 * c // 2 + 1, SAMPLED))


def _edited_copies(c: int, edits: int, trials: int, seed: int) -> np.ndarray:
    """``trials`` random sequences of c words, and then a copy of each with that many random edits."""
    rng = np.random.default_rng(seed)
    originals, edited = [], []
    for _ in range(trials):
        words = rng.integers(1, 1 << 62, c + edits, dtype=np.int64).tolist()
        other = list(words)
        for _ in range(edits):
            kind, place = rng.integers(3), int(rng.integers(max(1, min(len(other), c))))
            fresh = int(rng.integers(1, 1 << 62))
            if kind == 0:
                other.insert(place, fresh)
            elif kind == 1 and len(other) > 1:
                other.pop(place)
            else:
                other[place] = fresh
        originals.append(words[:c])
        edited.append((other + [0] * c)[:c])
    return np.array(originals + edited, np.int64).view(np.uint64).ravel()


@lru_cache(maxsize=None)
def repetitions(c: int, edits: int, recall: float) -> int | None:
    """Walks needed so that a sequence of c words with that many random edits is met with the given recall, in two separate
    draws of such sequences; None if ``MOST_REPETITIONS`` do not reach it."""
    if edits == 0:
        return 1
    starts, needed = np.arange(2 * TRIALS) * c, 0
    for draw in range(2):
        flat, met = _edited_copies(c, edits, TRIALS, c * 1000 + edits + 1_000_003 * draw), np.zeros(TRIALS, bool)
        for walk in range(MOST_REPETITIONS):
            h = embed(flat, starts, starts + c, walk, sampled_steps(c, walk))
            met |= h[:TRIALS] == h[TRIALS:]
            if met.mean() >= recall:
                needed = max(needed, walk + 1)
                break
        else:
            return None
    return needed


@dataclass
class ItemClass:
    """The pieces of one length class and their hash tables: sorted keys, and the piece of each key, by walk."""

    words: int
    edits: int
    pairs: int  # distinct word pairs that each piece has at least
    pieces: list[tuple[int, int]]  # item, and the piece's first word in it
    tables: list[tuple[np.ndarray, np.ndarray]] | None  # None: every window with enough pairs is aligned


@dataclass
class ItemBlock:
    numbers: list[int]
    hashes: list[np.ndarray]
    pairs: np.ndarray
    classes: list[ItemClass]


def build_block(items: list[tuple[int, str]], max_edits: float, recall: float) -> ItemBlock:
    """The index of a bounded block of (item id, text)."""
    kept, hashes = [], []
    for at in range(0, len(items), 500):
        cut = Slice(pa.array([t for _, t in items[at : at + 500]], pa.string()))
        h = cut.hashes(fold_case=True)
        for i in np.flatnonzero(cut.n_words > 0):
            kept.append(items[at + i][0])
            hashes.append(h[cut.first_word[i] : cut.first_word[i + 1]].copy())
    by_class: dict[int, list[tuple[int, int]]] = {}
    bounds: dict[int, int] = {}
    for i, h in enumerate(hashes):
        n = max(1, -(-len(h) // LONGEST_PIECE))
        c = length_class(len(h) // n)
        by_class.setdefault(c, []).extend((i, len(h) * k // n) for k in range(n))
        bounds[c] = max(bounds.get(c, 0), edit_bound(len(h), max_edits) // n)
    pairs, classes = [np.zeros(0, np.uint64)], []
    for c, members in sorted(by_class.items()):
        starts_of = np.concatenate([hashes[i][at : at + c] for i, at in members])
        starts = np.arange(len(members)) * c
        walks, tables = repetitions(c, bounds[c], recall), []
        for walk in range(walks or 0):
            keys = embed(starts_of, starts, starts + c, walk, sampled_steps(c, walk))
            order = np.argsort(keys, kind="stable")
            tables.append((keys[order], order))
        own = [np.unique(pair_hashes(hashes[i][at : at + c])) for i, at in members]
        classes.append(ItemClass(c, bounds[c], min(map(len, own)), members, tables if walks else None))
        pairs += own
    return ItemBlock(kept, hashes, np.unique(np.concatenate(pairs)), classes)


def pair_hashes(h: np.ndarray) -> np.ndarray:
    return mix(h[:-1] * _STEP + mix(h[1:]))


def edit_distance(item: np.ndarray, stretch: np.ndarray, bound: int) -> tuple[int, int]:
    """Least edits that turn ``item`` into a start of ``stretch``, and that start's length; bound + 1 where it is more."""
    n = len(stretch)
    if len(item) <= n and np.array_equal(item, stretch[: len(item)]):
        return 0, len(item)
    if np.isin(item, stretch).sum() < len(item) - bound:  # a word that is not there costs an edit
        return bound + 1, 0
    places = np.arange(n + 1)
    row = places.copy()
    for k, word in enumerate(item, 1):
        best = np.minimum(np.append(k, row[:-1] + (stretch != word)), np.append(k, row[1:] + 1))
        row = np.minimum.accumulate(best - places) + places  # insertions run along the row
        if row.min() > bound:
            return bound + 1, 0
    at = int(np.argmin(row))
    return int(row[at]), at


def place_within(item: np.ndarray, stretch: np.ndarray, bound: int) -> tuple[int, int, int]:
    """Least edits that turn ``item`` into any part of ``stretch``, that part's first place and length; bound + 1 where it is more."""
    if np.isin(item, stretch).sum() < len(item) - bound:
        return bound + 1, 0, 0
    places = np.arange(len(stretch) + 1)
    row = np.zeros_like(places)
    for k, word in enumerate(item, 1):
        best = np.minimum(np.append(k, row[:-1] + (stretch != word)), np.append(k, row[1:] + 1))
        row = np.minimum.accumulate(best - places) + places
        if row.min() > bound:
            return bound + 1, 0, 0
    end = int(np.argmin(row))
    edits, length = edit_distance(item[::-1], stretch[max(0, end - len(item) - bound) : end][::-1], bound)
    return edits, end - length, length


def search(cut: Slice, block: ItemBlock, max_edits: float) -> list[tuple[int, int, int, int, int]]:
    """(row, item, first word, words, edits) of each row and item that lie within the bound, at the best place."""
    h = cut.hashes(fold_case=True)
    if not len(h):
        return []
    same_row = np.append(cut.row[1:] == cut.row[:-1], False)
    known = np.zeros(len(h), np.int64)
    if len(h) > 1 and len(block.pairs):
        two = pair_hashes(h)
        at = np.minimum(np.searchsorted(block.pairs, two), len(block.pairs) - 1)
        known[:-1] = (block.pairs[at] == two) & same_row[:-1]
        known[1:-1] &= two[1:] != two[:-1]  # of a word said over and over, one pair counts
    sums = np.concatenate([[0], np.cumsum(known)])
    row_end = cut.first_word[cut.row + 1]
    candidates: set[tuple[int, int]] = set()
    for group in block.classes:
        need = group.pairs - 2 * group.edits - 1  # one repeated pair may have begun before the window
        stop = np.minimum(np.arange(len(h)) + group.words + group.edits, row_end) - 1
        here = sums[np.maximum(stop, np.arange(len(h)))] - sums[:-1] >= need
        starts = np.flatnonzero(here & (row_end - np.arange(len(h)) >= group.words - group.edits))
        if not len(starts):
            continue
        ends = np.minimum(starts + group.words, row_end[starts])
        if group.tables is None:
            candidates.update((int(start), *piece) for start in starts for piece in group.pieces)
            continue
        for walk, (keys, members) in enumerate(group.tables):
            got = embed(h, starts, ends, walk, sampled_steps(group.words, walk))
            low, high = np.searchsorted(keys, got, "left"), np.searchsorted(keys, got, "right")
            for k in np.flatnonzero(high > low):
                candidates.update((int(starts[k]), *group.pieces[m]) for m in members[low[k] : high[k]])
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    tried: set[tuple[int, int]] = set()
    for start, i, offset in sorted(candidates):
        key = (int(cut.row[start]), i)
        if best.get(key, (1,))[0] == 0:
            continue
        item = block.hashes[i]
        bound = edit_bound(len(item), max_edits)
        if len(item) > LONGEST_PIECE:
            if (start - offset, i) in tried:  # another piece puts the item at the same place
                continue
            tried.add((start - offset, i))
            begin = max(start - offset - bound, int(cut.first_word[key[0]]))
            edits, first, length = place_within(item, h[begin : min(start - offset + len(item) + 2 * bound, int(row_end[start]))], bound)
            if edits <= bound and (key not in best or edits < best[key][0]):
                best[key] = (edits, begin + first - int(cut.first_word[key[0]]), length)
            continue
        edits, length = edit_distance(item, h[start : min(start + len(item) + bound, int(row_end[start]))], bound)
        if edits <= bound and (key not in best or edits < best[key][0]):
            best[key] = (edits, start - int(cut.first_word[key[0]]), length)
    return [(row, block.numbers[i], start, length, edits) for (row, i), (edits, start, length) in sorted(best.items())]


def item_blocks(benchmark: DataFrame, id_column: str = "item_id", text: str = "text") -> Iterator[list[tuple[int, str]]]:
    """The benchmark in blocks of at most ``BLOCK_ITEMS`` items and about ``BLOCK_BYTES`` of text."""
    block, held = [], 0
    for row in benchmark.select(F.col(id_column).cast("bigint"), F.coalesce(F.col(text), F.lit(""))).toLocalIterator():
        if block and (len(block) >= BLOCK_ITEMS or held + len(row[1]) > BLOCK_BYTES):
            yield block
            block, held = [], 0
        block.append((row[0], row[1]))
        held += len(row[1])
    if block:
        yield block


FOUND = "doc_id bigint, item_id bigint, first_word bigint, n_words bigint, edits bigint"


def found(docs: DataFrame, benchmark: DataFrame, max_edits: float = 0.2, recall: float = 0.9, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document row and item that lie within the bound: (doc_id, item_id, first_word, n_words, edits)."""
    spark, narrow = docs.sparkSession, docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text).alias("text"))
    result = None
    for items in item_blocks(benchmark):
        sent = spark.sparkContext.broadcast(build_block(items, max_edits, recall))

        def run(parts: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            block = sent.value
            for rows, cut in slices(parts):
                got = search(cut, block, max_edits)
                ids = rows.column(0).take(pa.array([g[0] for g in got], pa.int64()))
                rest = [pa.array([g[k] for g in got], pa.int64()) for k in range(1, 5)]
                yield pa.RecordBatch.from_arrays([ids, *rest], [f.split()[0] for f in FOUND.split(", ")])

        matches = narrow.mapInArrow(run, FOUND)
        result = matches if result is None else result.unionAll(matches)
    return spark.createDataFrame([], FOUND) if result is None else result


def without_benchmark(docs: DataFrame, benchmark: DataFrame, max_edits: float = 0.2, recall: float = 0.9, text: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no item is found, with their columns."""
    spark, columns = docs.sparkSession, docs.columns
    for items in item_blocks(benchmark):
        sent = spark.sparkContext.broadcast(build_block(items, max_edits, recall))

        def run(parts: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            block = sent.value
            for rows, cut in slices(parts, text):
                clean = np.ones(cut.rows, bool)
                clean[[g[0] for g in search(cut, block, max_edits)]] = False
                yield pa.RecordBatch.from_arrays(rows.filter(pa.array(clean)).columns, columns)

        docs = docs.mapInArrow(run, docs.schema)
    return docs
