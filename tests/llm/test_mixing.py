import hashlib
import math
import random
from collections import defaultdict

import pytest
from llm_texts import _package_on_workers, docs, empty, fold, odd  # noqa: F401
from pyspark.sql import functions as F

from wattloom.llm import mixing

SCHEMA = "doc_id bigint, text string, source string"


def targets(sizes):
    """Share by weight, stop at three times the size, share what is over again, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    capped, total = set(), sum(sizes.values())
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        open_weight = sum(weight[s] for s in names if s not in capped)
        out = {s: 3 * sizes[s] if s in capped else rest * weight[s] / open_weight for s in names}
        over = {s for s in names if s not in capped and out[s] > 3 * sizes[s]}
        if not over:
            return out
        capped |= over


def rows(seed, n, sources):
    rng = random.Random(seed)
    return [(i, "w " * int(rng.paretovariate(1.1) * 5), rng.choices(sources, range(1, len(sources) + 1))[0]) for i in range(n)]


@pytest.mark.parametrize("sources", [["a"], ["b", "a", None], ["ä", "z", "Z", "aa", None, "q", "r"]])
def test_targets_and_copies(spark, sources):
    data = rows(3, 700, sources)
    got = mixing.mix_copies(spark.createDataFrame(data, SCHEMA)).collect()
    sizes = defaultdict(int)
    for _, t, s in data:
        sizes[s] += len(fold(t))
    expected, taken, largest = targets(sizes), defaultdict(int), defaultdict(int)
    for r in got:
        assert r.size == len(fold(data[r.id][1])) and r.source_size == sizes[r.source]
        assert math.isclose(r.target, expected[r.source], rel_tol=1e-9)
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    for s in sizes:
        assert abs(taken[s] - expected[s]) <= 2 * largest[s]
    # systematic sampling by hand
    for s in sizes:
        u = int(hashlib.md5(f"7:{'' if s is None else s}".encode()).hexdigest()[:8], 16) / 2**32 if s is not None else None
        if u is None:
            continue
        step = expected[s] / sizes[s]
        order = sorted((r for r in got if r.source == s), key=lambda r: (r.size, r.id))
        assert [r.copies for r in order] == [math.floor((k + 1) * step + u) - math.floor(k * step + u) if r.size else 0 for k, r in enumerate(order)]


def test_reruns_and_partitions_agree(spark):
    table = spark.createDataFrame(rows(5, 300, ["a", "b"]), SCHEMA)
    once = sorted(mixing.mix_copies(table).collect())
    assert once == sorted(mixing.mix_copies(table.repartition(7)).collect())
    assert once != sorted(mixing.mix_copies(table, seed=8).collect())


def test_rows_come_once_per_copy(spark):
    table = spark.createDataFrame(rows(6, 200, ["a", "b", None]), SCHEMA).withColumn("copy", F.lit("x")).withColumn("id", F.lit(0))
    mixed = mixing.mixed_rows(table)
    assert mixed.columns == ["doc_id", "text", "source", "id", "copy"]
    copies = {r.id: r.copies for r in mixing.mix_copies(table).collect() if r.copies}
    got = defaultdict(list)
    for r in mixed.collect():
        got[r.doc_id].append(r.copy)
    assert {k: sorted(v) for k, v in got.items()} == {k: list(range(1, n + 1)) for k, n in copies.items()}


def test_odd_rows(odd, empty, docs):
    got = mixing.mix_copies(odd).collect()
    assert len(got) == odd.count() and all(r.taken == 0 for r in got if r.size == 0)
    assert mixing.mix_copies(empty).count() == 0 and mixing.mixed_rows(empty).count() == 0
    blank = mixing.mix_copies(docs(None, "", " ")).collect()
    assert [(r.target, r.taken) for r in blank] == [(0.0, 0)] * 3
    assert mixing.mixed_rows(odd).count() > 0
