import random

import numpy as np
import pytest

from llm_texts import _package_on_workers, docs, empty, fold, odd, prose  # noqa: F401
from wattloom.llm import jaccard_join as J
from wattloom.llm.components import components


def brute(texts, words, percent):
    sets = []
    for t in texts:
        w = fold(t)
        sets.append({tuple(w[i : i + words]) for i in range(len(w) - words + 1)} or ({tuple(w)} if w else set()))
    group = list(range(len(texts)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            same, both = len(sets[i] & sets[j]), len(sets[i] | sets[j])
            if both and 100 * same >= percent * both:
                a, b = sorted((root(i), root(j)))
                group[b] = a
    return [(len(s), root(i)) for i, s in enumerate(sets)]


def family(seed, n, copies, edits):
    """Near copies on both sides of the limit, in chains."""
    rng, words = random.Random(seed), prose(seed, n).split()
    out = []
    for _ in range(copies):
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(len(words))] = f"e{rng.randint(0, 10**6)}"
        if rng.random() < 0.3 and len(words) > 8:
            words = words[: -rng.randint(1, 4)]
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize(("words", "percent"), [(4, 85), (5, 80), (2, 95)])
def test_components_equal_brute_force(docs, words, percent):
    passage = prose(99, 60)
    texts = [t for s, n in enumerate((5, 8, 12, 20, 40, 90, 300)) for t in family(s, n, 9, 4)]
    texts += [passage + " " + prose(200 + i, 30 + i) for i in range(30)]
    texts += [None, "", " \n ", "a", "A", "a b", "a b c", "a b c d e f", texts[20], texts[20]]
    got = sorted(J.near_duplicates(docs(*texts), words, percent).collect())
    assert [(r.n_shingles, r.component_id) for r in got] == brute(texts, words, percent)


def test_every_close_pair_shares_a_probed_signature():
    """With any choice of popular shingles, so with any allocation."""
    rng, bands = np.random.default_rng(3), J.Bands(85)
    for trial in range(300):
        n = int(rng.integers(8, 400))
        pool = rng.integers(1, 1 << 62, 2 * n, dtype=np.int64).view(np.uint64)
        x, y = list(pool[:n]), list(pool[:n])
        extra = list(pool[n:])
        while True:
            z = list(y)
            z.append(extra.pop()) if rng.random() < 0.5 else z.pop(int(rng.integers(len(z))))
            same = len(set(x) & set(z))
            if 100 * same < 85 * (len(x) + len(z) - same) or not extra:
                break
            y = z
        popular = np.sort(rng.choice(pool[:n], int(n * rng.choice([0, 0.3, 0.8])), replace=False))
        h = np.concatenate([np.sort(np.array(x, np.uint64)), np.sort(np.array(y, np.uint64))])
        row = np.array([0] * len(x) + [1] * len(y))
        sizes = np.array([len(x), len(y)])
        keys, roles, names = J.signature_rows(h, row, sizes, J.fingerprints(h, row, sizes), bands, popular)
        if set(x) == set(y):
            continue
        of = [{(int(k), int(r)) for k, r, m in zip(keys, roles, names) if m == name} for name in dict.fromkeys(names.tolist())]
        probes = [{k for k, r in side if r == 0} for side in of]
        every = [{k for k, _ in side} for side in of]
        assert probes[0] & every[1] or probes[1] & every[0], (trial, n)


@pytest.mark.parametrize("n", [3, 60, 1500, 9000])
def test_sketches_bound_the_difference_and_tell_sets_apart_at_any_size(spark, n):
    rng = np.random.default_rng(n)
    h = rng.integers(1, 1 << 62, 4 * n, dtype=np.int64).view(np.uint64)
    longer = n + n // 5
    near = np.concatenate([h[:longer], h[:n], h[2 * n : 3 * n]])
    sizes = np.array([longer, n, n])
    made = J.sketches(near, np.repeat([0, 1, 2], sizes), sizes, 80).to_pylist()
    rows = spark.createDataFrame([(made[0], made[1]), (made[0], made[2]), (made[1], made[2]), (made[2], made[2])], "x array<bigint>, y array<bigint>")
    like, unlike, unlike_2, same = (r[0] for r in rows.select(J._bits_apart(rows.x, rows.y, 80)).collect())
    allowed = (longer + n) * 20 / 180
    short = np.array([c.to_numpy() for c in J.folded(J.sketches(near, np.repeat([0, 1, 2], sizes), sizes, 80))]).T
    assert np.bitwise_count((short[0] ^ short[1]).view(np.uint64)).sum() <= like and (len(made[0]) == 16) == (made[0] == short[0].tolist())
    assert like <= longer - n and same == 0
    assert n < 50 or (unlike > allowed and unlike_2 > 2 * n * 20 / 180)


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 101), (300, 299)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, 100: 100, 101: 100, 300: 299, 299: 299}


def test_odd_rows(odd):
    rows = J.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    assert {r.component_id for r in rows if r.id in (5, 6)} == {5}
    assert all(r.component_id == r.id and r.n_shingles == 0 for r in rows if r.id in (0, 1, 2))
    kept = J.one_of_each_group(odd.withColumnRenamed("lang", "component_id").withColumnRenamed("n_chars", "_GONE").withColumnRenamed("source", "sketch"))
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [0, 1, 2, 3, 4, 5, 5, 5, 7, 8, 9, 10, 50]
    assert kept.where("doc_id is null").count() == 2


def test_empty(empty):
    assert J.near_duplicates(empty).count() == 0
    assert J.one_of_each_group(empty).columns == empty.columns
