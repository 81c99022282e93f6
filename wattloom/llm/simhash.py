"""SimHash near duplicates by a hierarchical index in Gray order.

**Fingerprints.** A text's words, A-Z in lower case, give shingles of three words joined by blanks, repeats included (fewer words: the
whole sequence). A bit of the 64-bit fingerprint is set when more than half of the shingles' XXH64 values have it set.
Texts without words have fingerprint 0 and are linked like any other. Fingerprints link at ``most`` or fewer differing bits.

**Upper nodes over the cluster.** A node is a masked bit pattern: a mask of fixed bits and their values. The free bits of a node are cut
into ``most + 1`` blocks; two fingerprints that link agree on some block whole, so they meet in one of the ``most + 1`` nodes that
fix one block more. Equal fingerprints are one point. A node with more than ``CROWDED`` points is cut again, and only such a node. Nodes with
few free bits cannot be crowded, so this ends, whatever the fingerprints, and no task ever holds more than a bounded node.

**Index within a node.** Its points are sorted by Gray rank, in which neighbours share long patterns. Each run of ``FAN`` neighbours gets a parent that
factors out the bits all of them share; children keep only what is left. The search walks pairs of nodes from the top, adds
the differences in bits newly fixed on both sides to those found above, and drops a pair of whole groups when the sum exceeds
``most``. Links come out as a forest, at most one edge a point and node, so a group of k copies never gives k * k rows.

Defined results: NULL, empty and blank texts have fingerprint 0; rows with equal ids are separate rows; a NULL id is never a component id
unless nothing else is in its component; columns other than the id and the text are not read. Ids must be castable to bigint.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.llm.components import components
from wattloom.llm.storage import stored
from wattloom.llm.text import Slice, signed, slices

SEED = 42
CROWDED = 1024  # points of a node that one task searches; more are dealt to finer nodes
FAN = 8
_PAIRS = 500_000  # pairs of nodes held at once
_HASHED = 100_000
_ALL = (1 << 64) - 1


def shingle_hashes(words: Slice, size: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every shingle, in order of rows, and the number of each row."""
    lengths = words.ends - words.starts
    after = np.cumsum(lengths + 1)
    joined = np.full(int(after[-1]) if len(after) else 0, 0x20, np.uint8)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(owner)) + owner
    taken = words.bytes[place - (after - lengths - 1 - words.starts)[owner]] if len(owner) else words.bytes[:0]
    joined[place] = np.where((taken >= 65) & (taken <= 90), taken + 32, taken)
    begins, ends = after - lengths - 1, after - 1
    short = (words.n_words > 0) & (words.n_words < size)
    per_row = np.where(short, 1, np.maximum(words.n_words - size + 1, 0))
    row = np.repeat(np.arange(words.rows), per_row)
    first = words.first_word[row] + np.arange(len(row)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    last = np.where(short[row], words.first_word[row + 1] - 1, first + size - 1) if len(row) else first
    whole, digest = joined.tobytes(), xxhash.xxh64_intdigest
    hashes = np.empty(len(row), np.uint64)
    for a in range(0, len(row), _HASHED):
        spans = zip(begins[first[a : a + _HASHED]].tolist(), ends[last[a : a + _HASHED]].tolist())
        hashes[a : a + _HASHED] = np.fromiter((digest(whole[s:e], SEED) for s, e in spans), np.uint64)
    return hashes, per_row


def simhash(hashes: np.ndarray, per_row: np.ndarray) -> np.ndarray:
    """The fingerprint of each row."""
    out, full = np.zeros(len(per_row), np.uint64), np.flatnonzero(per_row)
    bounds = np.cumsum(per_row)
    for i, end in zip(full.tolist(), bounds[full].tolist()):
        n = int(per_row[i])
        votes = np.zeros(64, np.int64)
        for a in range(end - n, end, _HASHED):
            bits = np.unpackbits(hashes[a : min(end, a + _HASHED)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            votes += bits.sum(0, dtype=np.uint32)
        out[i] = np.packbits(2 * votes > n, bitorder="little").view(np.uint64)[0]
    return out


def fingerprints(docs: DataFrame, size: int = 3, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, point): the fingerprint of each row of ``docs``, as a signed long."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, words in slices(parts):
            yield pa.RecordBatch.from_arrays([rows.column(0), signed(simhash(*shingle_hashes(words, size)))], ["id", "point"])

    narrow = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text).alias("text"))
    return narrow.mapInArrow(run, "id bigint, point bigint")


def gray_rank(point: Column) -> Column:
    """The place of a bit pattern in Gray order, as a signed long in the same order."""
    rank = point
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    return rank.bitwiseXOR(F.lit(-(1 << 63)))


def finer_masks(mask: int, most: int) -> list[int]:
    """The masks that fix one more of ``most + 1`` blocks of the free bits."""
    free = [b for b in range(64) if not mask >> b & 1]
    cut = [round(k * len(free) / (most + 1)) for k in range(most + 2)]
    return [mask | sum(1 << b for b in free[a:z]) for a, z in zip(cut, cut[1:])]


def _long(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def _dealt(points: DataFrame, finer: dict[int, list[int]]) -> DataFrame:
    """(mask, node, point) of ``points`` (mask, point) under the next finer masks."""
    next_masks = F.create_map(*(F.lit(x) if isinstance(x, int) else F.array(*map(F.lit, x)) for m, ms in finer.items() for x in (_long(m), [_long(k) for k in ms])))
    dealt = points.select(F.explode(F.element_at(next_masks, F.col("mask"))).alias("mask"), "point")
    return dealt.select("mask", F.col("mask").bitwiseAND(F.col("point")).alias("node"), "point")


def upper_nodes(points: DataFrame, most: int = 2, crowded: int = CROWDED) -> DataFrame:
    """(mask, node, point): the nodes that each of the distinct ``points`` (point) lies in, none of more than ``crowded`` points."""
    masks, found = [0], None
    dealt = points.select(F.lit(0).cast("bigint").alias("mask"), "point")
    while True:
        finer = {m: finer_masks(m, most) for m in masks}
        dealt = _dealt(dealt, finer)
        counts = dealt.groupBy("mask", "node").agg(F.count(F.lit(1)).alias("_points"))
        full = stored(counts.where(F.col("_points") > crowded).select("mask", "node"), "crowded-nodes")
        if full.isEmpty():
            return dealt if found is None else found.union(dealt)
        here = dealt.join(full, ["mask", "node"], "left_anti")
        found = here if found is None else found.union(here)
        dealt = dealt.join(full, ["mask", "node"], "left_semi").select("mask", "point")
        masks = [r.mask & _ALL for r in full.select("mask").distinct().collect()]  # at most (most + 1) times more each round, for few rounds


class GrayIndex:
    """Levels of nodes over points that are sorted by ``group`` and by Gray rank within a group; no node spans two groups."""

    def __init__(self, points: np.ndarray, group: np.ndarray):
        self.masks, self.patterns = [np.full(len(points), _ALL, np.uint64)], [points]
        self.first: list[np.ndarray] = []
        ones, zeros = points, points  # bits set in all, bits set in any
        while len(group) and (group[1:] == group[:-1]).any():
            new = np.concatenate([[True], group[1:] != group[:-1]])
            start = np.flatnonzero(new)
            place = np.arange(len(group)) - np.repeat(start, np.diff(np.append(start, len(group))))
            first = np.flatnonzero(place % FAN == 0)
            ones, zeros = np.bitwise_and.reduceat(ones, first), np.bitwise_or.reduceat(zeros, first)
            self.first.append(np.append(first, len(group)))
            self.masks.append(~(ones ^ zeros))
            self.patterns.append(ones & self.masks[-1])
            group = group[first]

    def links(self, most: int) -> tuple[np.ndarray, np.ndarray]:
        """A forest over the places of points that link: (place, smallest place of its component)."""
        n = len(self.patterns[0])
        label, top = np.arange(n), len(self.first)
        roots = np.arange(len(self.patterns[-1]))
        waiting = [(top, roots, roots, np.zeros(len(roots), np.int64))]
        while waiting:
            level, a, b, found = waiting.pop()
            if not level:
                label = joined(label, a, b)
                continue
            first = self.first[level - 1]
            width = first[b + 1] - first[b]
            pairs = (first[a + 1] - first[a]) * width
            total = np.cumsum(pairs)
            cut = int(np.searchsorted(total, _PAIRS, "right"))
            if cut < len(a):
                cut = max(cut, 1)
                waiting.append((level, a[cut:], b[cut:], found[cut:]))
                a, b, found, width, pairs, total = a[:cut], b[:cut], found[:cut], width[:cut], pairs[:cut], total[:cut]
            at = np.repeat(np.arange(len(a)), pairs)
            k = np.arange(len(at)) - np.repeat(total - pairs, pairs)
            x, y = first[a[at]] + k // width[at], first[b[at]] + k % width[at]
            once = (x < y) | ((x == y) & (level > 1))
            at, x, y = at[once], x[once], y[once]
            above = self.masks[level][a[at]] & self.masks[level][b[at]]
            both = self.masks[level - 1][x] & self.masks[level - 1][y]
            apart = (self.patterns[level - 1][x] ^ self.patterns[level - 1][y]) & both & ~above
            so_far = found[at] + np.bitwise_count(apart)
            near = so_far <= most
            if near.any():
                waiting.append((level - 1, x[near], y[near], so_far[near]))
        return np.flatnonzero(label != np.arange(n)), label[label != np.arange(n)]


def joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels, each the smallest place of its component, after joining the components of ``a`` and ``b``."""
    while True:
        x, y = label[a], label[b]
        differ = x != y
        if not differ.any():
            return label
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label = label[label]


def linked_points(nodes: DataFrame, most: int = 2) -> DataFrame:
    """(a, b): a forest of the links within each of the ``nodes`` (mask, node, point)."""

    def search(mask: np.ndarray, node: np.ndarray, point: np.ndarray) -> pa.RecordBatch:
        new = np.concatenate([[True], (mask[1:] != mask[:-1]) | (node[1:] != node[:-1])])
        place, label = GrayIndex(point.view(np.uint64), np.cumsum(new)).links(most)
        return pa.RecordBatch.from_arrays([pa.array(point[label]), pa.array(point[place])], ["a", "b"])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 3  # the last node may go on in the next batch
        for part in parts:
            held = [np.concatenate([h, part.column(i).to_numpy()]) for i, h in enumerate(held)]
            if not len(held[0]):
                continue
            last = int(np.flatnonzero((held[0] != held[0][-1]) | (held[1] != held[1][-1])).max(initial=-1)) + 1
            if last:
                yield search(*(h[:last] for h in held))
                held = [h[last:] for h in held]
        if len(held[0]):
            yield search(*held)

    in_order = nodes.repartition("mask", "node").sortWithinPartitions("mask", "node", gray_rank(F.col("point")))
    return in_order.mapInArrow(run, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, size: int = 3, most: int = 2, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, fingerprint, component_id): one row for each row of ``docs``; the component is named by its smallest id."""
    every = stored(fingerprints(docs, size, id_column, text), "fingerprints")
    points = stored(every.groupBy("point").agg(F.min("id").alias("smallest")), "points")
    links = linked_points(upper_nodes(points.select("point"), most), most)
    labels = components(stored(links, "links")).select(F.col("node").alias("point"), "component")
    grouped = points.join(labels, "point", "left").withColumn("component", F.coalesce("component", "point"))
    smallest = grouped.groupBy("component").agg(F.min("smallest").alias("component_id"))
    named = grouped.join(smallest, "component").select("point", "component_id")
    return every.join(named, "point").select(
        "id", F.lower(F.lpad(F.hex("point"), 16, "0")).alias("fingerprint"), "component_id"
    )
