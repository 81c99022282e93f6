"""Quality rules: counts over words and lines, and compression bands.

Counted rules: a document fails with fewer than ``min_words`` words, or where more than ``max_repeat_percent`` of its
words lie in 8-word windows that the text has twice or more.

Compression bands: the zstandard size of the whole text over its bytes, and the same for fixed chunks of
``CHUNK`` bytes, in every text of two chunks or more. Text that repeats itself packs too well and random text too badly. What is usual depends on the
length, so each length band has its own lowest and highest whole-text ratio. Chunks are all of one length, so they share their limits, which are
narrow; a junk stretch that a long text would hide shows in its own chunks. How many chunks may lie outside falls with the length: none
of up to four, and one in twenty of many (``tolerated``).

The bands are fixed values, wider on both sides than prose of any language that we know: they depend on neither the corpus nor its size.

Defined results: NULL and empty texts have zero counts, no ratio (NULL) and fail for having too few words.
Rows with equal ids are treated on their own. Texts of any length are read whole; zstandard runs over one text at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from wattloom.llm.text import GAP, STARTS_CODE_POINT, Slice, mix, slices, windows

SYMBOLS = "#*$%&|<>"
#: Bytes up to which a band reaches; lowest and highest ratio of packed to plain bytes in it.
BANDS = ((256, 0.40, 1.30), (1024, 0.38, 0.90), (2048, 0.36, 0.72), (4096, 0.34, 0.68), (16384, 0.31, 0.64), (None, 0.27, 0.62))
CHUNK = 1024
CHUNK_LIMITS = (0.40, 0.67)
TOLERATED = ((4, 0.24), (32, 0.12), (None, 0.05))  # up to so many chunks; share of them that may lie outside the limits
LEVEL = 3

_is_symbol = np.zeros(256, bool)
_is_symbol[list(SYMBOLS.encode())] = True

ADDED = {
    "n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long",
    "base_failed": "boolean", "whole_ratio": "double", "chunks": "long", "bad_chunks": "long", "kept": "boolean",
}


def repeated_words(words: Slice) -> np.ndarray:
    """For each row, the words in 8-word windows that its text has twice or more."""
    hashes, first = windows(words, words.hashes(fold_case=False), 8)
    inside = np.zeros(len(words.starts) + 1, np.int64)
    if len(first):
        keyed = mix(hashes ^ mix(words.row[first].astype(np.uint64)))
        _, at, counts = np.unique(keyed, return_inverse=True, return_counts=True)
        again = first[counts[at] > 1]
        np.add.at(inside, again, 1)
        np.add.at(inside, again + 8, -1)
    covered = np.cumsum(inside)[:-1] > 0
    return np.bincount(words.row[covered], minlength=words.rows).astype(np.int64)


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.split()]
    return len(lines) - len(set(lines))


def compression(text: bytes, packer: zstandard.ZstdCompressor) -> tuple[float | None, int, int]:
    """Ratio of the whole text, number of chunks, and chunks outside the limits.

    The last piece joins the chunk before it, so that no chunk is shorter than ``CHUNK`` unless the text is.
    """
    if not text:
        return None, 0, 0
    whole = len(packer.compress(text)) / len(text)
    n = max(1, len(text) // CHUNK)
    if n == 1:
        return whole, 0, 0
    edges = [i * CHUNK for i in range(n)] + [len(text)]
    ratios = [len(packer.compress(text[a:b])) / (b - a) for a, b in zip(edges, edges[1:])]
    return whole, n, sum(not CHUNK_LIMITS[0] <= r <= CHUNK_LIMITS[1] for r in ratios)


def in_band(n_bytes: int, whole: float | None, chunks: int, bad: int) -> bool:
    """The verdict of the compression bands."""
    if whole is None:
        return False
    _, low, high = next(band for band in BANDS if band[0] is None or n_bytes <= band[0])
    return low <= whole <= high and (not chunks or bad <= tolerated(chunks) * chunks)


def tolerated(chunks: int) -> float:
    """The share of so many chunks that may lie outside the chunk limits."""
    return next(share for most, share in TOLERATED if most is None or chunks <= most)


def measure(rows: pa.RecordBatch, words: Slice, at: int, min_words: int, max_repeat_percent: int) -> list[pa.Array]:
    packer = zstandard.ZstdCompressor(level=LEVEL)
    n_repeat = repeated_words(words)
    failed = (words.n_words < min_words) | (100 * n_repeat > max_repeat_percent * words.n_words)
    texts = [x.as_py() or b"" for x in rows.column(at).cast(pa.binary())]
    packed = [compression(x, packer) for x in texts]
    kept = [not f and in_band(len(x), *p) for f, x, p in zip(failed, texts, packed)]
    data = words.bytes
    columns = [
        words.n_words, words.per_row(STARTS_CODE_POINT[data] & ~GAP[data]), words.per_row(_is_symbol[data]),
        [duplicate_lines(x) for x in texts], n_repeat, failed, *zip(*packed), kept,
    ]
    types = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}
    return [pa.array(c, types[t]) for c, t in zip(columns, ADDED.values())]


def quality_rules(docs: DataFrame, min_words: int = 20, max_repeat_percent: int = 30, text: str = "text") -> DataFrame:
    """``docs`` with the counts and verdicts of ``ADDED`` (replacing columns of those names)."""
    columns = [c for c in docs.columns if c not in ADDED]
    schema = docs.select(*columns).schema
    for name, kind in ADDED.items():
        schema = schema.add(name, kind)
    at = columns.index(text)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, words in slices(parts, text):
            found = measure(rows, words, at, min_words, max_repeat_percent)
            yield pa.RecordBatch.from_arrays([*rows.columns, *found], [*columns, *ADDED])

    return docs.select(*columns).mapInArrow(run, schema)
