"""Quality classifier: a sparse ensemble of rules over text statistics.

1. Each text gives some fifteen statistics (``STATISTICS``), in one pass over the whole texts.
2. Shallow trees are grown on labelled rows; each path from a root to a node is a rule: a conjunction of
   ``statistic <= t`` and ``statistic > t``.
3. A logistic model with an L1 penalty over all rules keeps the few that matter.
4. The rules left become one Spark column expression over the statistics, so scoring is plain SQL.

Learning takes at most ``TRAINING_ROWS`` labelled rows, those with the smallest hash of their id; that bound is a
parameter. All rows are scored. Labels, language, source and id are no inputs.

Defined results: NULL text counts as empty; its statistics are 0 and it gets a score like any other. Rows with a NULL
label or id are not learned from. Without labelled rows every score is 0.5. Repeated rows get equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from wattloom.llm.storage import stored
from wattloom.llm.text import GAP, STARTS_CODE_POINT, Slice, mix, slices, windows

TRAINING_ROWS = 8000

STATISTICS = (
    "words", "characters", "word_length", "distinct_words", "distinct_pairs", "same_as_previous", "symbols", "capitals", "digits",
    "punctuation", "exclamations", "long_words", "short_words", "lines_per_word", "repeated_lines", "not_ascii",
)

_byte = np.arange(256)
_letter = ((_byte >= 65) & (_byte <= 90)) | ((_byte >= 97) & (_byte <= 122)) | (_byte >= 0x80)
_capital = (_byte >= 65) & (_byte <= 90)
_digit = (_byte >= 48) & (_byte <= 57)
_symbol = np.isin(_byte, list(b"#*$%&|<>{}[]\\^~=+_@"))
_punctuation = np.isin(_byte, list(b".,;:!?'\"()-"))


def _distinct(row: np.ndarray, hashes: np.ndarray, rows: int) -> np.ndarray:
    keys, at = np.unique(mix(hashes ^ mix(row.astype(np.uint64))), return_index=True)
    return np.bincount(row[at], minlength=rows)


def statistics(words: Slice) -> np.ndarray:
    """One row of ``STATISTICS`` for each text."""
    data, n, rows = words.bytes, words.n_words, words.rows
    hashes = words.hashes(fold_case=True)
    pairs, first = windows(words, hashes, 2)
    one = np.maximum(n, 1)
    chars = words.per_row(STARTS_CODE_POINT[data] & ~GAP[data])
    letters = np.maximum(words.per_row(_letter[data] & STARTS_CODE_POINT[data]), 1)
    length = words.ends - words.starts
    again = first[hashes[first] == hashes[first + 1]] if len(first) else first
    newline = data == 10
    n_lines = words.per_row(newline) + 1
    repeated = np.zeros(rows, np.int64)
    for i in np.flatnonzero(n_lines > 1):
        lines = [x for x in data[words.bounds[i] : words.bounds[i + 1]].tobytes().split(b"\n") if x]
        repeated[i] = len(lines) - len(set(lines))
    count = lambda mask: np.bincount(words.row[mask], minlength=rows)
    some_chars = np.maximum(chars, 1)
    columns = [
        n, chars, chars / one, _distinct(words.row, hashes, rows) / one,
        _distinct(words.row[first], pairs, rows) / np.maximum(n - 1, 1), np.bincount(words.row[again], minlength=rows) / one,
        words.per_row(_symbol[data]) / one, words.per_row(_capital[data]) / letters, words.per_row(_digit[data]) / some_chars,
        words.per_row(_punctuation[data]) / one, words.per_row(data == 33) / one, count(length > 12) / one, count(length < 3) / one,
        n_lines / one, repeated / n_lines, words.per_row((data >= 0x80) & STARTS_CODE_POINT[data]) / some_chars,
    ]
    return np.column_stack(columns).astype(np.float64)


def beside_statistics(docs: DataFrame, prefix: str, text: str = "text") -> DataFrame:
    """``docs`` with the statistics of each row as further columns, named with ``prefix``."""
    names = [f"{prefix}{c}" for c in STATISTICS]
    schema = StructType([*docs.schema.fields, *(StructField(name, DoubleType()) for name in names)])
    columns = docs.columns

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, words in slices(parts, text):
            yield pa.RecordBatch.from_arrays([*rows.columns, *map(pa.array, statistics(words).T)], [*columns, *names])

    return docs.mapInArrow(run, schema)


def with_statistics(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, STATISTICS...) of each row."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, words in slices(parts, "text"):
            yield pa.RecordBatch.from_arrays([rows.column(0), *map(pa.array, statistics(words).T)], ["id", *STATISTICS])

    schema = "id bigint, " + ", ".join(f"{c} double" for c in STATISTICS)
    return docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text).alias("text")).mapInArrow(run, schema)


Rule = tuple[tuple[int, bool, float], ...]  # (statistic, above, threshold) conditions that all hold


def grow_rules(x: np.ndarray, y: np.ndarray, trees: int, depth: int, seed: int, bins: int = 32) -> list[Rule]:
    """All root-to-node paths of ``trees`` trees, each on half the rows and half the statistics."""
    rng = np.random.default_rng(seed)
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) for column in x.T]
    binned = np.column_stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)])
    found: dict[Rule, None] = {}

    def split(rows: np.ndarray, path: Rule, columns: np.ndarray) -> None:
        labels = y[rows]
        if len(path) == depth or len(rows) < 20 or labels.min() == labels.max():
            return
        best = (1e-9, None)
        whole, ones = len(rows), labels.sum()
        parent = ones * (whole - ones) / whole
        for f in columns:
            if not len(edges[f]):
                continue
            n = np.cumsum(np.bincount(binned[rows, f], minlength=len(edges[f]) + 1))[:-1]
            k = np.cumsum(np.bincount(binned[rows, f], labels, len(edges[f]) + 1))[:-1]
            left = np.where(n > 0, k * (n - k) / np.maximum(n, 1), 0)
            m, j = whole - n, ones - k
            right = np.where(m > 0, j * (m - j) / np.maximum(m, 1), 0)
            gain = np.where((n >= 10) & (m >= 10), parent - left - right, 0)
            at = int(np.argmax(gain))
            if gain[at] > best[0]:
                best = (gain[at], (int(f), at))
        if best[1] is None:
            return
        f, at = best[1]
        below = binned[rows, f] <= at
        for side, part in ((False, rows[below]), (True, rows[~below])):
            rule = (*path, (f, side, float(edges[f][at])))
            found[rule] = None
            split(part, rule, columns)

    for _ in range(trees):
        rows = np.sort(rng.permutation(len(x))[: max(1, len(x) // 2)])
        split(rows, (), np.sort(rng.permutation(x.shape[1])[: (x.shape[1] + 1) // 2]))
    return list(found)


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    return np.logical_and.reduce([(x[:, f] > t) if above else (x[:, f] <= t) for f, above, t in rule])


@dataclass
class RuleModel:
    intercept: float
    rules: list[Rule]
    weights: list[float]

    def column(self, prefix: str = "") -> Column:
        """The score, from 0 to 1, as one expression over the statistics (in columns named with ``prefix``)."""
        margin = F.lit(float(self.intercept))
        for rule, weight in zip(self.rules, self.weights):
            tests = [F.col(prefix + STATISTICS[f]) > t if above else F.col(prefix + STATISTICS[f]) <= t for f, above, t in rule]
            condition = tests[0]
            for test in tests[1:]:
                condition = condition & test
            margin = margin + F.when(condition, F.lit(float(weight))).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def fit_rules(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 3, l1: float = 0.002, steps: int = 300, seed: int = 7) -> RuleModel:
    """Rules of the trees, weighted by L1-penalised logistic regression (accelerated proximal gradient steps)."""
    if not len(y):
        return RuleModel(0.0, [], [])
    prior = (y.sum() + 1) / (len(y) + 2)
    rules = grow_rules(x, y, trees, depth, seed)
    if not rules:
        return RuleModel(float(np.log(prior / (1 - prior))), [], [])
    active = np.column_stack([holds(r, x) for r in rules]).astype(np.float32)
    _, keep = np.unique(np.packbits(active > 0, axis=0), axis=1, return_index=True)  # rules with equal rows count once
    keep = np.sort(keep)
    rules, active = [rules[i] for i in keep], active[:, keep]
    n = len(y)
    v = np.ones(active.shape[1], np.float32)
    for _ in range(20):
        v = active.T @ (active @ v)
        v /= np.linalg.norm(v)
    step = 1 / (0.25 * (np.linalg.norm(active @ v) ** 2 / n + 1))
    w, b = np.zeros(active.shape[1]), float(np.log(prior / (1 - prior)))
    z, c, t = w.copy(), b, 1.0
    for _ in range(steps):
        error = 1 / (1 + np.exp(-(active @ z.astype(np.float32) + c))) - y
        moved = z - step * (active.T @ error.astype(np.float32)) / n
        w_next, b_next = np.sign(moved) * np.maximum(np.abs(moved) - step * l1, 0), c - step * float(error.mean())
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, c = w_next + (t - 1) / t_next * (w_next - w), b_next + (t - 1) / t_next * (b_next - b)
        w, b, t = w_next, b_next, t_next
    used = np.flatnonzero(np.abs(w) > 1e-3)
    return RuleModel(float(b), [rules[i] for i in used], [float(w[i]) for i in used])


def fold(id_column: Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``; NULL for a NULL id."""
    return F.crc32(id_column.cast("string").cast("binary")) % folds


def learn(stats: DataFrame, labels: DataFrame, label: str = "quality", rows: int = TRAINING_ROWS, held_out_fold: int = 0) -> RuleModel:
    """Fit on at most ``rows`` labelled rows whose fold is not ``held_out_fold``."""
    known = labels.select(F.col("doc_id").cast("bigint").alias("id"), F.col(label).cast("double").alias("label"))
    known = known.where(F.col("label").isNotNull() & (fold(F.col("id")) != held_out_fold))
    sample = stats.join(known, "id").orderBy(F.xxhash64("id"), "label", *STATISTICS).limit(rows)
    got = sample.select("label", *STATISTICS).toPandas().to_numpy(np.float64)
    return fit_rules(got[:, 1:], got[:, 0])


def classify(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.3, label: str = "quality", rows: int = TRAINING_ROWS,
    id_column: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(id, held_out, score, predicted): one row for each row of ``docs``; statistics are computed once and written."""
    stats = stored(with_statistics(docs, id_column, text), "text-statistics")
    score = learn(stats, labels, label, rows).column()
    return stats.select(
        "id", F.coalesce(fold(F.col("id")) == 0, F.lit(False)).alias("held_out"), score.alias("score")
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, label: str = "quality", rows: int = TRAINING_ROWS) -> DataFrame:
    """The rows of ``docs`` whose score is ``threshold`` or more, with their columns; no text is shuffled."""
    model = learn(with_statistics(docs), labels, label, rows)
    prefix = "_statistic_"
    return beside_statistics(docs, prefix).where(model.column(prefix) >= threshold).select(*docs.columns)
