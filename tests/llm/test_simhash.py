import random

import numpy as np
import pytest
import xxhash
from llm_texts import _package_on_workers, docs, empty, fold, odd, prose  # noqa: F401
from pyspark.sql import functions as F

from wattloom.llm import simhash as S


def fingerprint(text, size=3):
    words = fold(text)
    shingles = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest_reachable(points, most=2):
    group = list(range(len(points)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(points)):
        for j in range(i):
            if (points[i] ^ points[j]).bit_count() <= most:
                a, b = sorted((root(i), root(j)))
                group[b] = a
    return [root(i) for i in range(len(points))]


def chains(seed, families, members, flips=3):
    """Families whose members walk away from each other, on both sides of the limit."""
    rng, out = random.Random(seed), []
    for _ in range(families):
        x = rng.getrandbits(64)
        for _ in range(members):
            for b in rng.sample(range(64), rng.randint(0, flips)):
                x ^= 1 << b
            out.append(x)
    return out


def signed(points):
    return [(int(np.uint64(p).astype(np.int64)),) for p in points]


def test_fingerprints_and_components_equal_brute_force(docs):
    texts = [prose(s, n) for s, n in enumerate((5, 8, 20, 90, 300, 2000))] + [None, "", " \n ", "a", "A", "a b", "a b c", "É x y Z", "Q q Q q Q q"]
    base = prose(50, 400).split(" ")
    for i in range(40):
        texts.append(" ".join([*base[: 20 + i], f"e{i}", *base[21 + i :]]))
    got = sorted(S.near_duplicates(docs(*texts)).collect())
    points = [fingerprint(t) for t in texts]
    assert [int(r.fingerprint, 16) for r in got] == points and {len(r.fingerprint) for r in got} == {16}
    assert [r.component_id for r in got] == smallest_reachable(points)


@pytest.mark.parametrize("most", [0, 1, 2, 3])
def test_index_finds_every_link(most):
    for seed in range(6):
        points = sorted(set(chains(seed, 12, 25)))
        gray = [0] * len(points)
        for i, p in enumerate(points):
            rank = p
            for s in (1, 2, 4, 8, 16, 32):
                rank ^= rank >> s
            gray[i] = rank
        points = [p for _, p in sorted(zip(gray, points))]
        place, label = S.GrayIndex(np.array(points, np.uint64), np.zeros(len(points), np.int64)).links(most)
        got = list(range(len(points)))
        for p, c in zip(place.tolist(), label.tolist()):
            got[p] = c
        assert got == smallest_reachable(points, most)


def test_groups_are_not_searched_across():
    points = np.array([5, 5, 7, 7], np.uint64)
    place, label = S.GrayIndex(points, np.array([0, 1, 1, 2])).links(2)
    assert (place.tolist(), label.tolist()) == ([2], [1])


@pytest.mark.parametrize("crowded", [70, 1000])
def test_crowded_nodes_are_cut_and_lose_nothing(spark, crowded):
    points = sorted(set(chains(3, 6, 40, 2) + [1 << b for b in range(64)] + list(range(64))))
    table = spark.createDataFrame(signed(points), "point bigint")
    nodes = S.upper_nodes(table, 2, crowded)
    assert nodes.groupBy("mask", "node").count().agg(F.max("count")).first()[0] <= crowded
    links = [(r.a, r.b) for r in S.linked_points(nodes).collect()]
    at = {p: i for i, (p,) in enumerate(signed(points))}
    group = list(range(len(points)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for a, b in links:
        x, y = sorted((root(at[a]), root(at[b])))
        group[y] = x
    assert [root(i) for i in range(len(points))] == smallest_reachable(points)


def test_masks_cover_all_free_bits():
    for mask in (0, 0xFF, (1 << 60) - 1, (1 << 63) - 1):
        finer = S.finer_masks(mask, 2)
        assert len(finer) == 3 and all(m & mask == mask for m in finer)
        parts = [m & ~mask for m in finer]
        assert sum(parts) == parts[0] | parts[1] | parts[2] == ((1 << 64) - 1) & ~mask


def test_gray_neighbours_differ_in_one_bit(spark):
    rows = spark.range(0, 256).select(F.col("id").alias("p"), S.gray_rank(F.col("id")).alias("rank")).orderBy("rank").collect()
    assert all((a.p ^ b.p).bit_count() == 1 for a, b in zip(rows, rows[1:]))


def test_odd_rows(odd):
    clashing = odd.withColumn("point", F.lit("mine")).withColumn("component", F.lit(1)).withColumn("id", F.lit(2)).withColumn("mask", F.lit(3))
    rows = S.near_duplicates(clashing).collect()
    assert len(rows) == odd.count()
    assert {(r.fingerprint, r.component_id) for r in rows if r.id in (0, 1, 2)} == {("0" * 16, 0)}
    assert {r.component_id for r in rows if r.id in (5, 6)} == {5} and len([r for r in rows if r.id == 5]) == 3
    alone = S.near_duplicates(odd.where("doc_id is null and text is not null")).collect()
    assert [r.component_id for r in alone] == [None]


def test_empty(empty):
    assert S.near_duplicates(empty).count() == 0
