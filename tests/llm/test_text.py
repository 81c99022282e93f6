import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_texts import _package_on_workers  # noqa: F401
from wattloom.llm.text import WORD, Slice, slices, windows

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAbZ é日  \t\n\x0b\x0c\r", max_size=30)), max_size=8)


@given(TEXTS)
@settings(max_examples=150, deadline=None)
def test_words_are_those_of_the_pattern(texts):
    cut = Slice(pa.array(texts, pa.string()))
    expected = [re.findall(WORD, t or "") for t in texts]
    assert [cut.word(i).decode() for i in range(len(cut.starts))] == [w for ws in expected for w in ws]
    assert cut.n_words.tolist() == [len(ws) for ws in expected]
    plain, folded = cut.hashes(False), cut.hashes(True)
    words = [w for ws in expected for w in ws]
    lower = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words]
    assert len({(h, w) for h, w in zip(plain.tolist(), words)}) == len(set(words)) == len(set(plain.tolist()))
    assert len({(h, w) for h, w in zip(folded.tolist(), lower)}) == len(set(lower)) == len(set(folded.tolist()))


def test_windows_stay_in_their_row():
    cut = Slice(pa.array(["a b c", None, "a b", "a b c d"]))
    hashes, first = windows(cut, cut.hashes(True), 3)
    assert first.tolist() == [0, 5, 6]
    assert hashes[0] == hashes[1] != hashes[2]


def test_slices_cover_all_rows_in_order():
    batch = pa.RecordBatch.from_arrays([pa.array(range(50)), pa.array(["ab " * 60_000 if i % 7 == 0 else None for i in range(50)])], ["id", "text"])
    got = [(rows.column(0).to_pylist(), cut.n_words) for rows, cut in slices(iter([batch]))]
    assert len(got) > 1
    assert [i for ids, _ in got for i in ids] == list(range(50))
    assert np.concatenate([n for _, n in got]).tolist() == [60_000 if i % 7 == 0 else 0 for i in range(50)]
