"""N-gram Jaccard join by partitioning the universe of shingles.

Texts become sets of hashed word shingles; equal sets are one node. Two sets x and y of sizes s <= l are linked when
100 * intersection >= percent * union, so they differ in at most H = (s + l)(100 - percent) / (100 + percent) shingles.

**Segments.** Sizes fall into bands so narrow that linked sets lie in one band or in neighbouring ones. Each band has its
own bound H and cuts the universe, by hash, into H + 1 segments. A set goes to its own band and to the one below. If two
sets differ in at most H shingles, they agree on some segment.

**Allocation.** A segment without rare shingles (empty, or only shingles that very many sets have) would meet too many
sets. A set may drop such segments. For each one dropped it raises a spare segment (the first few of the band, with two
rare shingles or more) from "equal" to "at most one shingle apart", which keeps the sum of the bounds: with bounds t_i of
-1 (dropped), 0 or 1 and sum(t_i + 1) = H + 1, some segment differs in at most t_i. For spare segments all
one-deletion neighbours are indexed. A set that cannot pay for dropping a segment keeps it, so nothing is lost.
Popular shingles are found over all texts with a bounded summary per task; they only steer costs.

**Verification.** Rows of equal signature meet in sorted order and stream past their first probing set, the pivot; pairs
with the pivot are verified exactly on the full sets. A bucket that this leaves in several components gets two more pivots in
turn, drawn by hash from outside the first one's component; what is still across components then is verified pair by pair.
No sets are made for pairs that an exact bound rules out: their sizes, and parity sketches. Each shingle flips one bit, so
sets differ in as many shingles as their sketches differ in bits, or more. A sketch has eight bits or more for each shingle that linked
sets of its size may differ in (1,024 at least), so it tells unrelated sets apart at any size. All are compared folded to 1,024 bits, in
plain columns, first; larger sets then by the whole of the shorter sketch, with the longer one folded to it.
Sketches come with the names, in the first pass. Full sets are made only for names in pairs that are left: a bitmap of fixed
size over their documents' ids lets each task pass over most texts, and what it lets through by chance is dropped by name.
Pairs inside a component can add nothing to the components and are skipped. So a group of k near copies costs about k pairs.

Defined results: texts without words, NULL included, have empty sets and are linked with nothing; texts with fewer words than
a shingle have one shingle of all their words; rows with equal ids are separate rows; a NULL id never becomes a
component id unless nothing else is in its component. Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.components import components
from wattloom.llm.storage import Scratch, stored, unused
from wattloom.llm.text import Slice, mix, signed, slices, windows

POPULAR = 60_000  # most shingles that can count as popular: bounds the summaries and what is sent to the tasks
COMMON_FROM = 20  # distinct sets that make a shingle popular, whatever the number of sets: buckets of rarer ones stay small
_REMEMBERED = 500_000  # sets a task remembers, to emit the signatures of equal sets once
MEMBERSHIP = 1 << 24  # bits of the map over ids whose sets are wanted; a full map costs time, not results
FOLDED = [f"s{i}" for i in range(16)]  # 64 bits each
_SEGMENT, _CONTENT = np.uint64(0x1F83D9ABFB41BD6B), np.uint64(0x5BE0CD19137E2179)


class Bands:
    """Size bands, with their number of segments and spare segments."""

    def __init__(self, percent: int):
        self.percent, self.lows = percent, [1]

    def _reach(self, size: int) -> None:
        while self.lows[-1] <= size * 2 + 2:
            low = self.lows[-1]
            self.lows.append(max(low + 1, 100 * (low - 1) // self.percent + 1))

    def of(self, sizes: np.ndarray) -> np.ndarray:
        self._reach(int(sizes.max(initial=1)))
        return np.searchsorted(self.lows, sizes, "right") - 1

    def segments(self, bands: np.ndarray) -> np.ndarray:
        """H + 1 for the largest sizes that meet in a band."""
        most = np.array(self.lows)[bands + 1] - 1
        return (most + 100 * most // self.percent) * (100 - self.percent) // (100 + self.percent) + 1

    @staticmethod
    def spares(segments: np.ndarray) -> np.ndarray:
        usual = 0.015 * segments
        return np.minimum(segments // 2, np.ceil(usual + 2 * np.sqrt(usual)).astype(np.int64))


def shingle_sets(words: Slice, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct shingles of all rows, the row of each, and the number of each row; sorted by row."""
    hashes = words.hashes(fold_case=True)
    h, first = windows(words, hashes, size)
    row = words.row[first]
    for i in np.flatnonzero((words.n_words > 0) & (words.n_words < size)):
        whole = np.full(1, words.n_words[i], np.uint64)
        for k in range(words.first_word[i], words.first_word[i + 1]):
            whole = mix(whole * np.uint64(0x9E3779B97F4A7C15) + hashes[k])
        h, row = np.append(h, whole), np.append(row, i)
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    h, row = h[new], row[new]
    return h, row, np.bincount(row, minlength=words.rows)


def fingerprints(h: np.ndarray, row: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit name for each row's set; equal sets have equal names. 0 for empty sets."""
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(mix(h ^ _CONTENT), out=sums[1:])
    ends = np.cumsum(sizes)
    total = sums[ends] - sums[ends - sizes]
    return np.where(sizes > 0, mix(total + sizes.astype(np.uint64)), np.uint64(0))


def signature_rows(
    h: np.ndarray, row: np.ndarray, sizes: np.ndarray, names: np.ndarray, bands: Bands, popular: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, role, name) of all rows. Roles: 0 probes with an equal segment, 1 a dropped segment that only others
    may probe, 2 a one-deletion neighbour."""
    at = np.searchsorted(popular, h)
    rare = np.ones(len(h), bool) if not len(popular) else popular[np.minimum(at, len(popular) - 1)] != h
    content_of = mix(h ^ _SEGMENT)
    fraction = (mix(h + _SEGMENT) >> np.uint64(40)).astype(np.int64)
    keys, roles, named = [], [], []
    own = bands.of(sizes)
    for band in (own, own - 1):
        m = np.where((sizes > 0) & (band >= 0), bands.segments(np.maximum(band, 0)), 0)
        m = np.where(m > 1, m, 0)  # one segment: only equal sets, which are one node already
        use = m[row] > 0
        if not use.any():
            continue
        first = np.concatenate([[0], np.cumsum(m)])
        segment = (fraction[use] * m[row[use]]) >> 24
        group = first[row[use]] + segment
        order = np.argsort(group, kind="stable")
        group, token, is_rare = group[order], content_of[use][order], rare[use][order]
        starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        content, n_rare = np.zeros(first[-1], np.uint64), np.zeros(first[-1], np.int64)
        content[group[starts]] = np.add.reduceat(token, starts)
        n_rare[group[starts]] = np.add.reduceat(is_rare.astype(np.int64), starts)
        owner = np.repeat(np.arange(len(m)), m)
        place = np.arange(first[-1]) - first[owner]
        salt = mix((band[owner].astype(np.uint64) << np.uint64(40)) ^ place.astype(np.uint64) ^ _CONTENT)
        hot = n_rare == 0
        spare = place < bands.spares(m)[owner]
        payable = np.bincount(owner[spare & (n_rare > 1)], minlength=len(m))
        rank = np.cumsum(hot)
        before = np.concatenate([[0], rank])[first[:-1]]
        dropped = hot & (rank - before[owner] <= payable[owner])
        keys.append(mix(content + salt))
        roles.append(dropped.astype(np.int8))
        named.append(names[owner])
        near = (spare & (n_rare > 1))[group] & (n_rare[group] - is_rare >= 1)
        g = group[near]
        keys.append(mix(content[g] - token[near] + salt[g]))
        roles.append(np.full(len(g), 2, np.int8))
        named.append(names[owner[g]])
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int8), np.zeros(0, np.uint64)
    return np.concatenate(keys), np.concatenate(roles), np.concatenate(named)


def sketch_longs(sizes: np.ndarray, percent: int) -> np.ndarray:
    """The length of each set's sketch, a power of two, in longs."""
    bits = 16 * sizes * (100 - percent) // (100 + percent) + 1
    return np.left_shift(len(FOLDED), np.maximum(np.ceil(np.log2(bits / (64 * len(FOLDED)))).astype(np.int64), 0))


def sketches(h: np.ndarray, row: np.ndarray, sizes: np.ndarray, percent: int) -> pa.Array:
    """The parity sketch of each row, as a list of longs."""
    bounds = np.concatenate([[0], np.cumsum(sketch_longs(sizes, percent))])
    width = np.diff(bounds) * 64
    bit = (mix(h + _CONTENT) >> np.uint64(20)).astype(np.int64) & (width - 1)[row]
    place, times = np.unique(bounds[row] * 64 + bit, return_counts=True)
    odd = np.zeros(int(bounds[-1]) * 64, np.uint8)
    odd[place[times % 2 == 1]] = 1
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(np.packbits(odd).view(np.int64)))


def longer_ones(sketch: pa.Array) -> pa.Array:
    """The sketches that are longer than folded, NULL for others."""
    n = np.diff(sketch.offsets.to_numpy())
    keep = n > len(FOLDED)
    blocks = sketch.values.to_numpy().reshape(-1, len(FOLDED))[np.repeat(keep, n // len(FOLDED))]
    offsets = np.concatenate([[0], np.cumsum(np.where(keep, n, 0))])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(blocks.ravel()), mask=pa.array(~keep))


def folded(sketch: pa.Array) -> list[pa.Array]:
    """The columns ``FOLDED`` of some sketches."""
    blocks = sketch.values.to_numpy().reshape(-1, len(FOLDED))
    return [pa.array(c) for c in np.bitwise_xor.reduceat(blocks, sketch.offsets.to_numpy()[:-1] // len(FOLDED), axis=0).T]


def _narrow(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    return docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text).alias("text"))


def nodes(docs: DataFrame, words: int, percent: int, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n, name, sketch, FOLDED...): the set size, set name and parity sketch of each row; ``sketch`` is NULL where it is no longer than folded."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, cut in slices(parts):
            h, row, sizes = shingle_sets(cut, words)
            whole = sketches(h, row, sizes, percent)
            columns = [rows.column(0), pa.array(sizes), signed(fingerprints(h, row, sizes)), longer_ones(whole), *folded(whole)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n", "name", "sketch", *FOLDED])

    schema = "id bigint, n bigint, name bigint, sketch array<bigint>, " + ", ".join(f"{c} bigint" for c in FOLDED)
    return _narrow(docs, id_column, text).mapInArrow(run, schema)


def popular_shingles(docs: DataFrame, words: int, text: str = "text", scratch: Scratch | None = None) -> np.ndarray:
    """Shingles that about ``COMMON_FROM`` distinct sets or more have, the commonest ``POPULAR`` of them.

    Each task keeps counters of its commonest shingles (a shingle of a share over 1 / ``POPULAR`` of its
    sets is never pushed out for good); the counters are summed and the commonest come to the driver.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, kept, counts = set(), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        pending, held = [], 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            values = np.concatenate([kept, *pending])
            weights = np.concatenate([counts, np.ones(len(values) - len(kept), np.int64)])
            unique, at = np.unique(values, return_inverse=True)
            total = np.bincount(at, weights, len(unique)).astype(np.int64)
            top = np.argsort(-total, kind="stable")[:POPULAR]
            return unique[top], total[top]

        for _, cut in slices(parts):
            h, row, sizes = shingle_sets(cut, words)
            fresh = np.zeros(len(sizes), bool)
            for i, name in enumerate(fingerprints(h, row, sizes).tolist()):
                if name not in seen:
                    fresh[i] = True
                    if len(seen) < _REMEMBERED:
                        seen.add(name)
            pending.append(h[fresh[row]])
            held += len(pending[-1])
            if held > 1_000_000:
                kept, counts = merged()
                pending, held = [], 0
        kept, counts = merged()
        several = counts > 1
        yield pa.RecordBatch.from_arrays([signed(kept[several]), pa.array(counts[several])], ["shingle", "sets"])

    counted = docs.select(F.col(text).alias("text")).mapInArrow(run, "shingle bigint, sets bigint")
    summary = (scratch or Scratch(docs.sparkSession)).stored(
        counted.groupBy("shingle").agg(F.sum("sets").alias("sets")).where(F.col("sets") >= COMMON_FROM), "popular"
    )
    common = summary.orderBy(F.desc("sets"), "shingle").limit(POPULAR)
    return np.sort(common.select("shingle").toPandas()["shingle"].to_numpy(np.int64).view(np.uint64))


def signatures(docs: DataFrame, words: int, percent: int, popular: np.ndarray, text: str = "text") -> DataFrame:
    """(key, role, name) of every distinct set (sets met again in one task are not emitted again)."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, seen = Bands(percent), set()
        for _, cut in slices(parts):
            h, row, sizes = shingle_sets(cut, words)
            names = fingerprints(h, row, sizes)
            for i, name in enumerate(names.tolist()):
                if name in seen:
                    sizes[i] = 0
                elif len(seen) < _REMEMBERED:
                    seen.add(name)
            alive = sizes[row] > 0
            key, role, name = signature_rows(h[alive], row[alive], sizes, names, bands, popular)
            for a in range(0, len(key), 100_000):
                part = slice(a, a + 100_000)
                yield pa.RecordBatch.from_arrays([signed(key[part]), pa.array(role[part]), signed(name[part])], ["key", "role", "name"])

    return docs.select(F.col(text).alias("text")).mapInArrow(run, "key bigint, role tinyint, name bigint")


def buckets(rows: DataFrame) -> DataFrame:
    """(key, pivot, name, role): the other members of each key that has a probing set, beside the first such set."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key, last_pivot, last_probes = None, 0, False
        for part in parts:
            if not part.num_rows:
                continue
            key, role, name = (part.column(i).to_numpy() for i in range(3))
            new = np.concatenate([[last_key is None or key[0] != last_key], key[1:] != key[:-1]])
            starts = np.flatnonzero(new)
            run_of = np.cumsum(new) - 1  # -1: goes on from the batch before
            pivots, probes = np.append(name[starts], last_pivot), np.append(role[starts] == 0, last_probes)
            pivot = pivots[run_of]
            members = probes[run_of] & ~new & (name != pivot)
            last_key, last_pivot, last_probes = key[-1], pivot[-1], probes[run_of[-1]]
            if members.any():
                yield pa.RecordBatch.from_arrays([pa.array(x[members]) for x in (key, pivot, name, role)], ["key", "pivot", "name", "role"])

    return rows.repartition("key").sortWithinPartitions("key", "role", "name").mapInArrow(run, "key bigint, pivot bigint, name bigint, role tinyint")


def sets_of(docs: DataFrame, names: DataFrame, every: DataFrame, words: int, id_column: str, text: str) -> DataFrame:
    """(name, n, shingles) of the wanted ``names``; a name again where several documents of it were let through."""
    ids = every.join(names, "name").groupBy("name").agg(F.min(F.struct("id")).alias("_id"))
    bit = F.pmod(F.xxhash64("_id.id"), F.lit(MEMBERSHIP))
    flag = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit.bitwiseAND(63).cast("int"))
    wanted = ids.groupBy(F.shiftright(bit, 6).alias("place")).agg(F.bit_or(flag).alias("flags")).toPandas()  # of bounded size
    member = np.zeros(MEMBERSHIP >> 6, np.int64)
    member[wanted["place"].to_numpy(np.int64)] = wanted["flags"].to_numpy(np.int64)
    sent = docs.sparkSession.sparkContext.broadcast(member)

    def wanted_rows(part: pa.RecordBatch) -> pa.RecordBatch:
        place = part.column(0).to_numpy()
        return part.filter(pa.array((sent.value[place >> 6] >> (place & 63) & 1) > 0))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, cut in slices(map(wanted_rows, parts)):
            h, row, sizes = shingle_sets(cut, words)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), signed(h))
            yield pa.RecordBatch.from_arrays([signed(fingerprints(h, row, sizes)), pa.array(sizes), lists], ["name", "n", "shingles"])

    place = F.pmod(F.xxhash64(F.col(id_column).cast("bigint")), F.lit(MEMBERSHIP))
    made = docs.select(place.alias("place"), F.col(text).alias("text")).mapInArrow(run, "name bigint, n bigint, shingles array<bigint>")
    return made.join(names, "name", "left_semi")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with the sizes ``n_a``, ``n_b`` and the ``shared`` shingles of their whole sets."""
    b = sets.select(F.col("name").alias("b"), F.col("shingles").alias("_b"), F.col("n").alias("n_b"))
    a = sets.select(F.col("name").alias("a"), F.col("shingles").alias("_a"), F.col("n").alias("n_a"))
    return pairs.join(b, "b").join(a, "a").withColumn("shared", F.size(F.array_intersect("_a", "_b"))).drop("_a", "_b")


def linked(percent: int):
    return 100 * F.col("shared") >= percent * (F.col("n_a") + F.col("n_b") - F.col("shared"))


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(id, n_shingles, component_id): one row for each row of ``docs``."""
    scratch = Scratch(docs.sparkSession)
    every = scratch.stored(nodes(docs, words, percent, id_column, text), "names")
    popular = popular_shingles(docs, words, text=text, scratch=scratch)
    members = scratch.stored(buckets(signatures(docs, words, percent, popular, text)), "buckets")
    star = members.select(F.col("pivot").alias("a"), F.col("name").alias("b")).distinct()
    used = star.select(F.explode(F.array("a", "b")).alias("name")).distinct()
    cards = scratch.stored(every.select("name", "n", "sketch", *FOLDED).join(used, "name").dropDuplicates(["name"]), "cards")

    def links_of(pairs: DataFrame) -> DataFrame | None:
        pairs = scratch.stored(pairs, "pairs")
        if pairs.isEmpty():
            return None
        names = pairs.select(F.explode(F.array("a", "b")).alias("name")).distinct()
        sets = scratch.stored(sets_of(docs, names, every, words, id_column, text), "shingles")
        found = scratch.stored(verified(pairs, sets).where(linked(percent)).select("a", "b"), "found")
        scratch.drop("shingles")
        scratch.drop("pairs")
        return found

    found = [links_of(_possible_pairs(star, cards, percent))]
    labels = _labels(found, every, scratch)
    for pairs_of in (_star_of(1), _star_of(2), _across):
        full = _mixed_members(members, labels, scratch)
        found.append(None if full.isEmpty() else links_of(pairs_of(full, cards, percent)))
        scratch.drop("members")
        if found[-1] is not None:
            labels = _labels(found, every, scratch)
    named = every.select("id", "n", "name").join(labels.withColumnRenamed("node", "name"), "name", "left").withColumn("_group", F.coalesce("component", "name"))
    smallest = named.where(F.col("n") > 0).groupBy("_group").agg(F.min("id").alias("_smallest"))
    groups = stored(named.join(smallest, "_group", "left").select(
        "id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("_smallest")).otherwise(F.col("id")).alias("component_id")
    ), "groups")
    scratch.clear()
    return groups


def _labels(found: list[DataFrame | None], every: DataFrame, scratch: Scratch) -> DataFrame:
    """The components of all links found so far."""
    links = every.limit(0).select(F.col("name").alias("a"), F.col("name").alias("b"))
    for more in found:
        links = links if more is None else links.union(more)
    return components(links, scratch)


def _mixed_members(members: DataFrame, labels: DataFrame, scratch: Scratch) -> DataFrame:
    """Members of buckets that are not yet one component: their component, and whether they are outside
    the pivot's component (``odd``)."""
    group = labels.select(F.col("node").alias("name"), "component")
    pivots = labels.select(F.col("node").alias("pivot"), F.col("component").alias("_pivot_component"))
    full = (
        members.join(group, "name", "left").join(pivots, "pivot", "left")
        .withColumn("component", F.coalesce("component", "name"))
        .withColumn("odd", F.col("component") != F.coalesce("_pivot_component", "pivot"))
        .select("key", "name", "role", "component", "odd")
    ).distinct()
    mixed = full.groupBy("key").agg(F.max("odd").alias("_odd")).where("_odd").select("key")
    return scratch.stored(full.join(mixed, "key", "left_semi"), "members")


def _bits_apart(x, y, percent: int):
    """In how many bits two sketches differ, the longer one folded; sizes that may link differ by few foldings."""

    def folded(longer, other):
        half = F.size(longer) / 2
        halves = F.zip_with(F.slice(longer, F.lit(1), half.cast("int")), F.slice(longer, (half + 1).cast("int"), half.cast("int")), lambda p, q: p.bitwiseXOR(q))
        return F.when(F.size(longer) > F.size(other), halves).otherwise(longer)

    for _ in range(int(np.ceil(np.log2(100 / percent)))):
        x, y = folded(x, y), folded(y, x)
    return F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda total, n: total + n)


def _may_link(percent: int):
    """Whether the sizes and sketches of a pair (x and x_1) allow a link."""
    size = F.col("n") + F.col("n_1")
    sizes = 100 * F.least("n", "n_1") >= percent * F.greatest("n", "n_1")
    short = sum((F.bit_count(F.col(c).bitwiseXOR(F.col(f"{c}_1"))) for c in FOLDED), F.lit(0))
    within = lambda apart: apart * (100 + percent) <= size * (100 - percent)
    whole = F.col("sketch").isNull() | F.col("sketch_1").isNull() | within(_bits_apart(F.col("sketch"), F.col("sketch_1"), percent))
    return F.when(sizes & within(short), whole).otherwise(F.lit(False))


def _as_other(rows: DataFrame, *kept: str) -> DataFrame:
    return rows.select(*kept, *(F.col(c).alias(f"{c}_1") for c in rows.columns if c not in kept))


def _possible_pairs(pairs: DataFrame, cards: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that may be linked: by their sizes alone first, so that sketches travel only with what is left."""
    sizes = cards.select("name", "n")
    near = pairs.join(sizes.withColumnRenamed("name", "a"), "a").join(_as_other(sizes).withColumnRenamed("name_1", "b"), "b")
    near = near.where(100 * F.least("n", "n_1") >= percent * F.greatest("n", "n_1")).select("a", "b")
    both = near.join(cards.withColumnRenamed("name", "a"), "a").join(_as_other(cards).withColumnRenamed("name_1", "b"), "b")
    return both.where(_may_link(percent)).select("a", "b")


def _across_components():
    """Whether a pair of rows of a bucket is across components and probed by one side."""
    return (F.col("component") != F.col("component_1")) & ((F.col("role") == 0) | (F.col("role_1") == 0))


def _distinct_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("name", "name_1").alias("a"), F.greatest("name", "name_1").alias("b")).distinct()


def _star_of(seed: int):
    """Pairs (a, b) of a member of each bucket, drawn from outside the pivot's component, with the other members.

    The same pairs come from many buckets, so they are made different before sketches are joined to them.
    """

    def pairs(full: DataFrame, cards: DataFrame, percent: int) -> DataFrame:
        odd = full.where("odd").withColumn("_draw", F.xxhash64(F.lit(seed), "key", "name"))
        first = odd.groupBy("key").agg(F.min(F.struct("role", "_draw")).alias("_first"))  # probing members first
        drawn = odd.join(first, "key").where((F.col("_draw") == F.col("_first._draw")) & (F.col("role") == F.col("_first.role")))
        other = _as_other(drawn.select("key", "name", "role", "component"), "key")
        return _possible_pairs(_distinct_pairs(other.join(full, "key").where(_across_components())), cards, percent)

    return pairs


def _across(full: DataFrame, cards: DataFrame, percent: int) -> DataFrame:
    """(a, b): all pairs of a bucket in different components that may be linked."""
    known = full.join(cards, "name")
    other = _as_other(known.where("odd").drop("odd"), "key")
    pairs = other.join(known, "key").where(_across_components() & (~F.col("odd") | (F.col("name_1") < F.col("name"))) & _may_link(percent))
    return _distinct_pairs(pairs)


def one_of_each_group(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that have the smallest id of their component; rows that share an id are one document.

    Rows without an id stay. Only the ids that go are joined to the texts, so few of them need no shuffle of texts.
    """
    groups = near_duplicates(docs, words, percent)
    gone = unused("_gone", docs.columns)
    ids = stored(groups.where(F.col("component_id") != F.col("id")).select(F.col("id").alias(gone)).distinct(), "duplicates")
    return docs.join(ids, F.col("doc_id").cast("bigint") == F.col(gone), "left_anti")
