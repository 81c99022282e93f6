import math
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_texts import _package_on_workers, empty, fold, odd, prose  # noqa: F401
from pyspark.sql import functions as F

from wattloom.llm import language_model as L
from wattloom.llm.tokenizers import BYTE_BPE, byte_bpe


def held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 1


def check_base(rows, texts):
    tokens = [[*fold(t), None] for _, t in texts]
    counts = Counter(t for (i, _), ts in zip(texts, tokens) if not held_out(i) for t in ts)
    n, v = sum(counts.values()), len(counts)
    expected = Counter()
    for (i, _), ts in zip(texts, tokens):
        base = sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in ts)
        expected[i, held_out(i), len(ts), sum(counts[t] > 0 for t in ts), n, round(base, 6)] += 1
    assert Counter((r.id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows) == expected


@pytest.mark.parametrize("common", [0, 3, 10_000])
def test_base_scores_equal_brute_force(spark, monkeypatch, common):
    monkeypatch.setattr(L, "COMMON", max(common, 1))
    texts = [(i, prose(i, 5 + 7 * i, 60)) for i in range(40)] + [(100, None), (101, ""), (102, "Ä b\tB"), (3, prose(3, 26, 60)), (3, prose(3, 26, 60)), (None, "w1x"), (None, None)]
    check_base(L.score(spark.createDataFrame(texts, "doc_id bigint, text string")).collect(), texts)


def test_no_training_text(spark):
    out = [i for i in range(60) if held_out(i)][:3]
    texts = list(zip(out, ["a b", None, "a"]))
    rows = L.score(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()
    check_base(rows, texts)
    assert all(math.isfinite(r.score) for r in rows)


def windows(texts):
    encoder = L.Encoder(BYTE_BPE)
    import pyarrow as pa

    from wattloom.llm.text import Slice

    cut = Slice(pa.array(texts, pa.string()))
    return encoder(cut, cut.hashes(True))


def test_ids_are_those_of_the_tokenizer():
    texts = ["Ab cd", None, "don't  12\né", "  "]
    ids, sizes = windows(texts)
    expected = [[i for w in fold(t) for i in byte_bpe().encode_ordinary(" " + w)] + [L.END] for t in texts]
    assert ids.tolist() == [i for e in expected for i in e] and sizes.tolist() == list(map(len, expected))


def test_words_joined_for_the_tokenizer():
    import pyarrow as pa

    from wattloom.llm.text import Slice

    cut = Slice(pa.array(["Ab cÉ", None, "\tZ\u00a0z  12"], pa.string()))
    assert L.joined_words(cut, np.array([1, 0, 3, 2])) == " cÉ ab 12 z\u00a0z"


def test_blocks_in_order_hear_the_same():
    """Keys looked up once for two blocks, and a place without a target among the predicted."""
    rng, n = np.random.default_rng(3), 64
    model = L.Attention(n, members=8)
    targets, inputs, first = L.blocks(rng.integers(0, n, 400), np.array([150, 1, 60, 189]), n)
    before = inputs[np.maximum(np.arange(len(inputs)) - 1, 0)]
    one, other = (model._hear(inputs[3:], before[3:], first[3:], in_order)[-1] for in_order in (False, True))
    assert np.allclose(one, other, atol=1e-6)
    h, flat = other.reshape(-1, other.shape[-1]), targets[3:].ravel()
    log_p = model._predict(h, flat)[0]
    assert (log_p[flat < 0] == 0).all() and np.allclose(log_p[flat >= 0], model._predict(h[flat >= 0], flat[flat >= 0])[0])


@pytest.fixture(scope="module")
def trained():
    ids, sizes = windows([prose(i, 150, 80) for i in range(60)])
    classes = L.make_classes(np.bincount(ids, minlength=L.IDS).astype(float))
    targets, inputs, first = L.blocks(classes.of[ids], sizes, classes.n)
    before = inputs[np.maximum(np.arange(len(inputs)) - 1, 0)]
    model = L.Attention(classes.n)
    model.train(targets, inputs, before, first, steps=200)
    return classes, model


def test_gradients():
    rng, n = np.random.default_rng(1), 12
    model = L.Attention(n, members=4)
    targets, inputs, before = rng.integers(-1, n, (5, L.BLOCK)), rng.integers(0, n + 1, (5, L.BLOCK)), rng.integers(0, n + 1, (5, L.BLOCK))
    first = np.array([True, False, False, True, False])

    def loss():
        h = model._hear(inputs, before, first)[-1]
        return -model._predict(h[targets >= 0], targets[targets >= 0])[0].mean()

    sums = model.no_sums()
    model.add_gradients(sums, targets, inputs, before, first)
    assert sums["told"].tolist() == [pytest.approx(loss() * (targets >= 0).sum()), (targets >= 0).sum(), 5]
    for name, g in model.gradients(sums).items():
        w = model.weights[name]
        at = tuple(np.unravel_index(np.abs(g).argmax(), g.shape))
        kept = w[at]
        w[at] = kept + 1e-2
        up = loss()
        w[at] = kept - 1e-2
        down = loss()
        w[at] = kept
        assert abs((up - down) / 2e-2 - g[at]) < 0.02 * abs(g[at]) + 1e-4, name


def test_gradients_of_blocks_in_order_are_the_same():
    rng, n = np.random.default_rng(2), 64
    model = L.Attention(n, members=8)
    targets, inputs, before = *L.blocks(rng.integers(0, n, 400), np.array([150, 1, 60, 189]), n)[:2], None
    first = L.blocks(rng.integers(0, n, 400), np.array([150, 1, 60, 189]), n)[2]
    before = inputs[np.maximum(np.arange(len(inputs)) - 1, 0)]
    found = []
    for in_order in (False, True):
        sums = model.no_sums()
        for part in (slice(0, 4), slice(4, 30)):
            model.add_gradients(sums, targets[part], inputs[part], before[part], first[part], in_order)
        found.append(sums)
    assert all(np.allclose(found[0][k], found[1][k], atol=1e-4) for k in found[0])


def test_probabilities_are_proper(trained):
    """Over all ids, P(id | before) sums to 1 at every place."""
    classes, model = trained
    total = np.bincount(classes.of, np.exp(classes.log_share), classes.n)
    assert np.allclose(total, 1)
    inputs = np.full((classes.n, L.BLOCK), 3)
    inputs[:, 0] = classes.n
    targets = np.full((classes.n, L.BLOCK), -1)
    targets[:, 5] = np.arange(classes.n)
    p = np.exp(model.log_probabilities(targets, inputs, np.ones(classes.n, bool))[:, 5])
    assert abs(p.sum() - 1) < 1e-4


def test_each_id_is_scored_once_and_sees_the_past_only(trained):
    classes, model = trained
    rng = np.random.default_rng(0)
    sizes = np.array([1, 16, 17, 40])
    seq = rng.integers(0, classes.n, sizes.sum())
    targets, inputs, first = L.blocks(seq, sizes, classes.n)
    assert targets[targets >= 0].tolist() == seq.tolist() and first.sum() == 4
    whole = model.log_probabilities(targets, inputs, first)
    w, place = {k: x.astype(float) for k, x in model.weights.items()}, 0
    for n in sizes:  # one id at a time
        said = [classes.n, *seq[place : place + n - 1]]
        for i in range(n):
            seen = said[max(0, (i // L.BLOCK - 1) * L.BLOCK) : i + 1]
            x = w["embed"][seen]
            score = (x @ w["key"]) @ (x[-1] @ w["query"]) / np.sqrt(L.WIDTH) + w["near"][len(seen) - 1 - np.arange(len(seen))]
            a = np.exp(score - score.max())
            h = x[-1] + a / a.sum() @ (x @ w["value"])
            g, k = divmod(seq[place + i], L.MEMBERS)
            z, y = h @ w["group"] + w["group_bias"], h @ w["member"][g] + w["member_bias"][g]
            expected = z[g] - np.log(np.exp(z).sum()) + y[k] - np.log(np.exp(y).sum())
            assert abs(whole[targets >= 0][place + i] - expected) < 1e-4
        place += n
    changed = seq.copy()
    changed[-5:] = (changed[-5:] + 1) % classes.n
    other = model.log_probabilities(*L.blocks(changed, sizes, classes.n))
    kept = np.flatnonzero(targets.ravel() >= 0)[:-5]
    assert np.allclose(whole.ravel()[kept], other.ravel()[kept])


def test_model_beats_the_class_frequencies_on_other_texts(trained):
    classes, model = trained
    ids, sizes = windows([prose(1000 + i, 150, 80) for i in range(10)])
    seq = classes.of[ids]
    share = np.bincount(seq, minlength=classes.n) + 0.5
    assert model.log_probabilities(*L.blocks(seq, sizes, classes.n)).sum() > np.log(share / share.sum())[seq].sum()


def test_odd_rows(odd, empty):
    got = L.score(odd.withColumn("row", F.lit(1)).withColumn("id", F.lit(2)).withColumn("score", F.lit("x"))).collect()
    assert len(got) == odd.count() and all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in got)
    assert len({(r.n_tokens, round(r.score, 3)) for r in got if r.id == 5}) == 1
    assert L.score(empty).count() == 0


def texts_table(spark, texts, partitions):
    rows = spark.createDataFrame(texts, "id bigint, text string").repartition(partitions)
    keyed = rows.select(L.row_key("id", "text").alias("row"), "id", "text")
    return L.encoded(keyed.withColumn("part", F.pmod("row", F.lit(L.ROUNDS)).cast("int")), BYTE_BPE)


def test_every_training_text_is_learned_from(spark, monkeypatch):
    """Without any window for the start, all that the model knows comes from the tasks."""
    texts = [(i, "red green blue " * 200) for i in range(200)]
    ids, sizes = windows([t for _, t in texts[:1]])
    classes = L.make_classes(np.bincount(ids, minlength=L.IDS).astype(float))
    targets, inputs, first = L.blocks(classes.of[ids], sizes, classes.n)
    monkeypatch.setattr(L, "training_windows", lambda *_: (targets[:0], inputs[:0], inputs[:0], first[:0]))
    monkeypatch.setattr(L, "RATE", 0.1)
    model, n = L.fit(texts_table(spark, texts, 4), classes)
    assert n == 200 * len(targets)
    before = L.Attention(classes.n).log_probabilities(targets, inputs, first).sum()
    assert model.log_probabilities(targets, inputs, first).sum() > before / 2


def test_scores_do_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(L, "_AT_ONCE", 50)
    texts = [(i, prose(i, 20 + 11 * i % 300, 150)) for i in range(150)] + [(7, prose(7, 97, 150)), (900, None)]
    docs, found = spark.createDataFrame(texts, "doc_id bigint, text string"), []
    for partitions in (1, 2, 11):
        rows = L.score(docs.repartition(partitions)).collect()
        found.append(np.array(sorted((r.id, r.n_tokens, r.base_score, r.score) for r in rows)))
    assert all(np.allclose(found[0], other, rtol=1e-6, atol=0) for other in found[1:])


def test_context_moves_the_commonest_ids():
    rest = L.make_classes(1.0 / np.arange(1, L.IDS + 1))
    assert (rest.log_share[:950] == 0).all() and rest.n % L.MEMBERS == 0
