import random

import numpy as np
import pytest
import zstandard
from llm_texts import WORD, _package_on_workers, docs, empty, odd, prose  # noqa: F401
from pyspark.sql import functions as F

from wattloom.llm import quality_classifier as C
from wattloom.llm import quality_rules as R


def brute(text):
    words = WORD.findall(text or "")
    grams = {}
    for i in range(len(words) - 7):
        grams.setdefault(tuple(words[i : i + 8]), []).append(i)
    repeated = {k for places in grams.values() if len(places) > 1 for i in places for k in range(i, i + 8)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(repeated), n < 20 or 100 * len(repeated) > 30 * n


def test_counts_equal_brute_force(docs):
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["a", "b", "é#", "日本\n", "x|y", "\n", "\t<"]) for _ in range(rng.randint(0, 80))) for _ in range(150)]
    texts += [None, "", prose(1, 300), (prose(2, 40) + "\n") * 3, prose(3, 100) + "\n" + prose(3, 30), "a b c d e f g h " * 3]
    got = R.quality_rules(docs(*texts)).orderBy("doc_id").collect()
    assert [(r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got] == [brute(t) for t in texts]
    assert all(not r.kept for r in got if r.base_failed)


def test_bands():
    packer = zstandard.ZstdCompressor(level=R.LEVEL)
    rng = random.Random(2)
    verdict = lambda t: R.in_band(len(t), *R.compression(t, packer))
    usual = " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 8))) for _ in range(9000)).encode()
    assert verdict(usual) and verdict(usual[:300]) and verdict(usual[:3000])
    assert not verdict(b"abc def ghi " * 500)
    assert not verdict(rng.randbytes(20_000))
    assert not verdict(usual[:20_000] + b"same same " * 3000)  # usual as a whole, but too many chunks repeat
    assert R.compression(b"", packer) == (None, 0, 0) and not R.in_band(0, None, 0, 0)
    assert R.compression(usual[: 4 * R.CHUNK + 5], packer)[1] == 4


@pytest.mark.parametrize("size", [3_000, 8_000, 60_000])
@pytest.mark.parametrize("kind", ["base64", "repeated", "spam"])
def test_planted_junk_blocks_are_caught(kind, size):
    """A junk block of a quarter of the text, but of 1.5 KB at least, in prose that passes; and the prose itself."""
    packer, rng = zstandard.ZstdCompressor(level=R.LEVEL), random.Random(size)
    junk = {
        "base64": lambda n: "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(n)),
        "repeated": lambda n: ("click here now! " * n)[:n], "spam": lambda n: (prose(1, 30).replace("\n", " ") * n)[:n],
    }[kind]
    kept, caught = 0, 0
    for trial in range(20):
        text = " ".join("".join(rng.choice("eeetaoinshrdlucmf") for _ in range(rng.randint(2, 9))) for _ in range(size))[:size]
        at = rng.randrange(len(text))
        with_junk = text[:at] + junk(max(1536, size // 4)) + text[at:]
        kept += R.in_band(len(text), *R.compression(text.encode(), packer))
        caught += not R.in_band(len(with_junk), *R.compression(with_junk.encode(), packer))
    assert kept == 20 and caught >= 14, caught


def test_rules_on_odd_rows(odd, empty):
    clashing = odd.withColumn("kept", F.lit("mine")).withColumn("n_words", F.lit(-1))
    got = R.quality_rules(clashing)
    assert got.columns.count("kept") == 1 and got.count() == odd.count()
    assert all(not r.kept and r.n_words == 0 and r.whole_ratio is None for r in got.where("text is null").collect())
    assert R.quality_rules(empty).count() == 0


def junk(seed, n):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randint(0, 99)}{rng.choice(['###', '$$$', '|'])}" for _ in range(n)) if seed % 2 else f"Wx{seed} " * n


@pytest.fixture
def labelled(spark):
    rng = random.Random(5)
    rows = [(i, prose(i, rng.randint(5, 200)) if i % 4 else junk(i // 4, rng.randint(5, 200))) for i in range(900)]
    labels = [(i, int(i % 4 > 0)) for i in range(800)] + [(3, None), (None, 1), (10_000, 0)]
    return spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, quality int")


def test_held_out_accuracy_and_compiled_rules(labelled):
    docs, labels = labelled
    got = {r.id: r for r in C.classify(docs, labels).collect()}
    held = [r for r in got.values() if r.held_out]
    assert 100 < len(held) < 260
    assert np.mean([r.predicted == (r.id % 4 > 0) for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    kept = {r.doc_id for r in C.keep_good(docs, labels).collect()}
    assert kept == {i for i, r in got.items() if r.predicted}


def test_labels_of_the_held_out_fold_change_nothing(labelled):
    docs, labels = labelled
    other = labels.withColumn("quality", F.when(C.fold(F.col("doc_id")) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert sorted(C.classify(docs, labels).collect()) == sorted(C.classify(docs, other).collect())


def test_rules_are_paths_and_few():
    rng = np.random.default_rng(0)
    x = rng.random((2000, len(C.STATISTICS)))
    y = ((x[:, 2] > 0.5) & (x[:, 6] <= 0.3)).astype(float)
    model = C.fit_rules(x, y)
    score = 1 / (1 + np.exp(-(model.intercept + sum(w * C.holds(r, x) for r, w in zip(model.rules, model.weights)))))
    assert ((score > 0.5) == (y > 0)).mean() > 0.97
    assert 0 < len(model.rules) < 150 and max(map(len, model.rules)) <= 3


def test_classifier_on_odd_rows(spark, odd, empty, labelled):
    clashing = odd.withColumn("words", F.lit("mine")).withColumn("score", F.lit(1)).withColumn("id", F.lit(4))
    assert C.classify(clashing, labelled[1]).count() == odd.count()
    assert C.keep_good(clashing, labelled[1]).columns == clashing.columns
    none = labelled[1].limit(0)
    assert {r.score for r in C.classify(odd, none).collect()} == {0.5}
    assert C.classify(empty, labelled[1]).count() == 0
    one_class = spark.createDataFrame([(i, 1) for i in range(12)], "doc_id bigint, quality int")
    assert all(r.predicted == 1 for r in C.classify(odd, one_class).collect())
