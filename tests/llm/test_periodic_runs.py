import hashlib
import random
import zlib

import numpy as np
import pytest
from llm_texts import WORD, _package_on_workers, empty, odd, prose  # noqa: F401
from pyspark.sql import functions as F

from wattloom.llm import periodic_runs as P
from wattloom.llm import queries


def brute(words, least=6, exponent=4):
    """All runs by trying every period at every place."""
    best = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, exponent * q):
                best.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in best.items())


def collapsed(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def repetitive(rng, n):
    """Words over a small alphabet with planted periodic stretches, of any phase and next to each other."""
    out = []
    while len(out) < n:
        unit = [f"w{rng.randint(0, 3)}" for _ in range(rng.randint(1, rng.choice([2, 5, 40])))]
        out += (unit * rng.randint(1, 9))[: rng.randint(1, 9 * len(unit))]
        out += [f"x{rng.randint(0, 50)}" for _ in range(rng.choice([0, 0, 1, 3]))]
    return out[:n]


def test_cover_reaches_all_differences():
    for i in range(P.MODULUS):
        for d in range(P.MODULUS):
            s = P.SHIFT[i, d]
            assert (i + s) % P.MODULUS in P.COVER and (i + d + s) % P.MODULUS in P.COVER


@pytest.mark.parametrize("n", [40, 200, 3000])
def test_extensions_equal_comparison(n):
    rng = np.random.default_rng(n)
    unit = rng.integers(10, 14, 37)
    words = np.concatenate([np.tile(unit, n // 37 + 1)[:n], rng.integers(10, 12, n), np.tile(unit[:5], n // 5), [1]]).astype(np.uint64)
    words = np.concatenate([words, words[: n // 2], [2]])
    text = np.concatenate([np.zeros(len(words) - n // 2 - 1, np.int64), np.ones(n // 2 + 1, np.int64)])
    i, j = rng.integers(0, len(words), (2, 2000))
    i, j = i[i != j], j[i != j]
    expected = [next(k for k in range(len(words) + 1) if max(a, b) + k >= len(words) or words[a + k] != words[b + k]) for a, b in zip(i, j)]
    assert P.extensions(words, text, i, j).tolist() == expected


@pytest.mark.parametrize(("least", "exponent"), [(6, 4), (2, 2), (10, 3)])
def test_runs_equal_brute_force(least, exponent):
    rng = random.Random(least)
    texts = [repetitive(rng, rng.choice([0, 1, 3, 6, 7, 30, 120, 700])) for _ in range(60)]
    texts += [["a"] * 5, ["a"] * 6, ["a"] * 300, ["a", "b"] * 4, ["a", "b"] * 3, [], (["a"] * 8 + ["b"]) * 5]
    ids: dict[str, int] = {}
    hashes = np.array([ids.setdefault(w, 10**9 + len(ids)) for t in texts for w in t], np.uint64)
    row, start, length, period = P.runs(hashes, np.array([len(t) for t in texts]), least, exponent)
    got = [[] for _ in texts]
    for r, *run in zip(row.tolist(), start.tolist(), length.tolist(), period.tolist()):
        got[r].append(tuple(run))
    assert got == [brute(t, least, exponent) for t in texts]


def test_blocks_of_the_grid_change_nothing(monkeypatch):
    rng = random.Random(4)
    words = repetitive(rng, 900)
    hashes = np.array([int(w[1:]) + 10**6 * ord(w[0]) for w in words], np.uint64)
    whole = P.runs(hashes, np.array([500, 0, 400]), 6, 4)
    monkeypatch.setattr(P, "_GRID", 7)
    assert all((a == b).all() for a, b in zip(whole, P.runs(hashes, np.array([500, 0, 400]), 6, 4)))


def planted(doc_id, text):
    words = WORD.findall(text or "")
    if doc_id is None:
        return words
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, " ".join(repetitive(rng, rng.randint(0, 150))) if i % 3 else prose(i, rng.randint(1, 300)), "en", "s", 0) for i in range(120)]
    rows += [(200, None, None, None, None), (201, "", "", "", 0), (None, "a a a a a a\na a", None, None, None), (17, rows[17][1], "en", "s", 0)]
    rows += [(i, prose(i, 260), "en", "s", 0) for i in range(1000, 1060)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in queries.QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect()), key=str)
    expected = []
    for i, text, *_ in rows:
        words = planted(i, text)
        found = brute(words)
        s, n, q = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        expected.append((i, len(found), s, n, q, 1000 * n // q if found else None, sha("".join(f"{a},{b},{c}\n" for a, b, c in found)), sha(collapsed(words, found))))
    assert got == sorted(expected, key=str)


def test_odd_rows(odd):
    clashing = odd.withColumn("runs", F.lit("mine")).withColumn("id", F.lit(1)).withColumn("collapsed", F.lit(2))
    rows = P.find_runs(clashing).collect()
    assert len(rows) == odd.count()
    assert all(r.n_words == 0 and r.runs == [] and r.collapsed == "" for r in rows if r.id in (0, 1, 2))
    (wide,) = odd.where("doc_id = 10").collect()
    words = WORD.findall(wide.text)
    (got,) = [r for r in rows if r.id == 10]
    assert [tuple(x) for x in got.runs] == brute(words) == [(0, len(words), len(words) // 40)] and got.collapsed == " ".join(words[: len(words) // 40])
    assert all(r.runs == [] for r in rows if r.id == 9)


def test_empty(empty):
    assert P.find_runs(empty).count() == 0
