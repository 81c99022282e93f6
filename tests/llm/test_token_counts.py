import random

import pytest
from llm_texts import _package_on_workers, docs, empty, odd, prose  # noqa: F401
from pyspark.sql import functions as F

from wattloom.llm import queries as Q
from wattloom.llm import token_counts as T
from wattloom.llm.tokenizers import byte_bpe

encode = byte_bpe().encode_ordinary


def spliced(text, edits):
    n, end, taken = len(text), 0, []
    clip = lambda x: max(0, min(x, n))
    for a, b, new in sorted((clip(a), max(clip(a), clip(b)), new) for a, b, new in edits):
        if a >= end:
            taken.append((a, b, new))
            end = max(end, b)
    for a, b, new in reversed(taken):
        text = text[:a] + new + text[b:]
    return text, len(taken)


@pytest.mark.parametrize("leaf", [1, 8, 64])
def test_edits_equal_encoding_again(leaf):
    rng = random.Random(leaf)
    texts = [prose(i, rng.randint(1, 300)) for i in range(25)] + ["", "   ", "a" * 900, "\n\n  x  " * 100, "don't 12 é日本 " * 50]
    for text in texts:
        for _ in range(6):
            pieces = T.leaves(text, leaf)
            assert "".join(pieces) == text
            tree = T.tree_of([len(encode(p)) for p in pieces])
            assert tree[1] == len(encode(text))
            lengths, now = [len(p) for p in pieces], text
            for _ in range(2):  # a tree can be edited again
                edits = [
                    (a := rng.randint(-2, len(now) + 3), a + rng.choice([0, 0, 1, 2, 5, 40, 300]), rng.choice(["", " ", "\n", "xyz", " 12'", "[private]", " a b c " * rng.randint(1, 30)]))
                    for _ in range(rng.randint(1, 6))
                ]
                expected, done = spliced(now, edits)
                now, lengths, applied, skipped, _ = T.apply_edits(now, lengths, tree, edits, encode)
                assert (now, applied, applied + skipped) == (expected, done, len(edits))
                assert tree[1] == len(encode(now)) and sum(lengths) == len(now)
                half = len(tree) // 2
                assert all(tree[k] == tree[2 * k] + tree[2 * k + 1] for k in range(1, half))


def test_only_what_is_near_is_encoded_again():
    text = prose(3, 20_000)
    pieces, calls = T.leaves(text), []
    tree = T.tree_of([len(encode(p)) for p in pieces])
    T.apply_edits(text, [len(p) for p in pieces], tree, [(50_000, 50_003, "zz")], lambda t: calls.append(len(t)) or encode(t))
    assert sum(calls) < 5 * T.LEAF


def test_rows(spark, odd, empty):
    edits = [(0, 3, "new"), (1, 2, "lost"), (None, 1, "x"), (10**9, 10**9, " end"), (5, 5, None)]
    table = odd.withColumn("token_tree", F.lit("mine")).withColumn("n_edits", F.lit(7))
    table = T.with_trees(table).withColumn("edits", F.lit(None).cast(T.EDITS) if not edits else F.array(*(F.struct(F.lit(a).cast("bigint").alias("start"), F.lit(b).cast("bigint").alias("stop"), F.lit(r).cast("string").alias("replacement")) for a, b, r in edits)))
    got = T.recount(table).collect()
    assert len(got) == odd.count()
    for r in got:
        assert r.n_tokens_after == len(encode(r.edited)) == r.token_tree[1]
        assert (r.edited.endswith(" end") or len(r.edited) < 20) and r.n_edits + r.n_skipped == len(edits)
    plain = T.recount(T.with_trees(odd).withColumn("edits", F.lit(None).cast(T.EDITS))).collect()
    assert all(r.n_tokens == r.n_tokens_after and r.chars_encoded == 0 and r.n_edits == 0 for r in plain)
    assert sorted(r.n_tokens for r in plain) == sorted(len(encode(r.text or "")) for r in odd.collect())
    assert T.recount(T.with_trees(empty).withColumn("edits", F.lit(None).cast(T.EDITS))).count() == 0


def test_masking_edits(docs):
    table = T.with_trees(docs("mail joe@a.example.org or 12345 now", None, "1234 and 1234")).withColumn("edits", T.masking_edits())
    got = [r.edited for r in T.recount(table).orderBy("id").collect()]
    assert got == ["mail [private] or [private] now", "", "[private] and 1234"]


def test_every_match_is_masked(docs, monkeypatch):
    texts = ["1234 and 1234", "x 123456, then 1234 and 3456", "a@b.org ü日 a@b.org 55555 a@b.org", None, "", "none 123", "é 1234" * 400]
    expected = ["[private] and [private]", "x [private], then [private] and [private]", "[private] ü日 [private] [private] [private]", "", "", "none 123", "é [private]" * 400]
    got = T.recount(T.with_trees(docs(*texts)).withColumn("edits", T.every_match_edits())).orderBy("id").collect()
    assert [r.edited for r in got] == expected
    assert [r.n_edits for r in got] == [2, 3, 4, 0, 0, 0, 400] and all(r.n_skipped == 0 for r in got)
    assert all(r.n_tokens_after == len(encode(r.edited)) for r in got)
    monkeypatch.setattr(Q, "_table", lambda *_: docs(*texts))
    assert [r.n_edits for r in Q.QUERIES["op6_token_counts"](docs("").sparkSession, "").orderBy("doc_id").collect()] == [2, 3, 4, 0, 0, 0, 400]
