import random

import numpy as np
import pyarrow as pa
import pytest
from llm_texts import _package_on_workers, docs, empty, fold, odd, prose  # noqa: F401
from pyspark.sql import functions as F

from wattloom.llm import decontamination as D
from wattloom.llm.text import Slice


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row


def within(item, text, max_edits):
    """Least edits between the item and any stretch of the text, if within the bound."""
    bound = int(len(item) * max_edits)
    best = min((min(distance(item, text[s : s + len(item) + bound])) for s in range(len(text))), default=bound + 1)
    return best if best <= bound else None


def edited(words, edits, rng):
    out = list(words)
    for _ in range(edits):
        kind, at = rng.randint(0, 2), rng.randrange(len(out))
        if kind == 0:
            out.insert(at, f"n{rng.randint(0, 99999)}")
        elif kind == 1 and len(out) > 1:
            out.pop(at)
        else:
            out[at] = f"n{rng.randint(0, 99999)}"
    return out


@pytest.fixture(scope="module")
def items():
    return [(i, prose(1000 + i, n, 3000)) for i, n in enumerate([4, 7, 13, 20, 33, 50, 70] * 3)]


def test_recall_and_exactness_against_brute_force(spark, items):
    rng, texts = random.Random(11), []
    for i, item in items:
        words = item.split()
        for share in (0, 0.05, 0.1, 0.2, 0.5):
            texts.append(" ".join([prose(rng.random(), 30), *edited(words, int(len(words) * share), rng), prose(rng.random(), 25)]))
    texts += [prose(i, 150, 3000) for i in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {(r.doc_id, r.item_id): r for r in D.found(docs, spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    folded = [(i, fold(t)) for i, t in items]
    expected = {}
    for d, text in enumerate(texts):
        words = fold(text)
        for i, item in folded:
            if len(set(item) & set(words)) >= 0.6 * len(item) and (edits := within(item, words, 0.2)) is not None:
                expected[d, i] = edits
    assert set(got) <= set(expected)  # nothing beyond the bound
    assert len(got) >= 0.9 * len(expected)
    exact = {k for k, e in expected.items() if e == 0}
    assert len(exact) >= len(items) and exact <= set(got)
    for (d, i), r in got.items():
        stretch = fold(texts[d])[r.first_word : r.first_word + r.n_words]
        assert distance(dict(folded)[i], stretch)[-1] == r.edits <= int(0.2 * len(dict(folded)[i]))


def test_bounds_on_the_distance():
    h = lambda *w: np.array(w, np.uint64)
    assert D.edit_distance(h(1, 2, 3), h(1, 2, 3, 4), 1) == (0, 3)
    assert D.edit_distance(h(1, 2, 3), h(1, 9, 3, 4), 1) == (1, 3)
    assert D.edit_distance(h(1, 2, 3), h(1, 3), 1) == (1, 2)
    assert D.edit_distance(h(1, 2, 3), h(7, 8, 9), 2)[0] == 3


def test_close_embeddings_meet_and_far_ones_do_not():
    rng = np.random.default_rng(0)
    words = rng.integers(1, 1 << 60, (2, 40), dtype=np.int64).view(np.uint64)
    flat = np.concatenate([words[0], words[0], words[1]])
    starts = np.array([0, 40, 80])
    a, b, c = D.embed(flat, starts, starts + 40, 3, D.sampled_steps(40, 3))
    assert a == b != c
    assert D.repetitions(40, 8, 0.9) >= D.repetitions(40, 2, 0.9) >= 1


def test_blocks_and_clean_documents(spark, docs, items, monkeypatch):
    monkeypatch.setattr(D, "BLOCK_ITEMS", 5)
    bench = spark.createDataFrame([*items, (98, None), (99, ""), (100, items[4][1])], "item_id bigint, text string")
    table = docs(prose(1, 90), prose(2, 40) + " " + items[4][1] + " end", items[10][1].upper(), None, "")
    assert sorted((r.doc_id, r.item_id) for r in D.found(table, bench).collect()) == [(1, 4), (1, 100), (2, 10)]
    kept = D.without_benchmark(table.withColumn("item_id", F.lit(1)), bench)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 3, 4] and kept.columns[-1] == "item_id"


def test_odd_rows(spark, odd, empty, items):
    bench = spark.createDataFrame([(1, prose(1, 60)), (None, "one two")], "item_id bigint, text string")
    assert sorted(r.doc_id for r in D.found(odd, bench).collect()) == [5, 5, 5, 6]
    assert D.without_benchmark(odd, bench).count() == odd.count() - 4
    assert D.found(empty, bench).count() == 0
    assert D.found(odd, bench.limit(0)).count() == 0 and D.without_benchmark(odd, bench.limit(0)).count() == odd.count()


def test_search_of_no_words():
    assert D.search(Slice(pa.array([None, " "], pa.string())), D.build_block([(1, "a b c")], 0.2, 0.9), 0.2) == []


@pytest.mark.parametrize("n", [200, 400, 800])
def test_long_items_edited_at_the_bound_are_found(n):
    rng, hits = random.Random(n), 0
    for k in range(12):
        item = prose(5000 + n + k, n, 3000)
        copy = edited(item.split(), int(n * 0.2), rng)
        text = " ".join([prose(rng.random(), 40), *copy, prose(rng.random(), 40)])
        got = D.search(Slice(pa.array([text], pa.string())), D.build_block([(7, item)], 0.2, 0.9), 0.2)
        for _, _, first, length, edits in got:
            assert distance(fold(item), fold(text)[first : first + length])[-1] == edits <= int(n * 0.2)
        hits += len(got)
    assert hits >= 10


def test_walks_that_do_not_reach_the_recall_are_no_limit(monkeypatch):
    monkeypatch.setattr(D, "MOST_REPETITIONS", 1)
    D.repetitions.cache_clear()
    item = prose(77, 50, 3000)
    text = " ".join([prose(3, 20), *edited(item.split(), 10, random.Random(4)), prose(4, 20)])
    assert D.repetitions(44, 10, 0.9) is None
    assert [g[1] for g in D.search(Slice(pa.array([text], pa.string())), D.build_block([(7, item)], 0.2, 0.9), 0.2)] == [7]
    D.repetitions.cache_clear()
