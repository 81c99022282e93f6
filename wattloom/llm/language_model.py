"""Language-model scoring: a smoothed word model and a causal self-attention model on subword ids.

**Base.** Words (and one end per text) of the training texts are counted; a text's base score sums log10((c + 0.5) / (N + 0.5 (V + 1))).
Counts are joined, not broadcast: only the ``COMMON`` most frequent words, a bounded table, go to the tasks; rarer
words of each document meet their counts in an equi-join, in which no word is frequent any more.

**Model.** A text is the subword ids of its words, A-Z in lower case and each with a blank before it, and an end. The model gives
P(id) = P(class | up to 31 ids before) P(id | class): the most frequent ids are classes of their own, the others
share classes of about equal mass. The first factor is one head of causal self-attention over the classes, with a learned weight
for each distance, and a softmax in two steps: over groups of classes, and over the classes of the group. The second factor comes from the
counts of all training texts. All are proper distributions, and so is their product.

**Training.** Ids are written once, and read by everything below. The driver finds a start, on at most ``TRAINING_WINDOWS`` windows. From
there every window of every training text is learned from once: the texts fall into ``ROUNDS`` parts by a hash of the row, a round
sums the gradients of all windows of its part, and the driver takes one Adam step. A task sends one row of the size of the
model, and ``_SUMMING`` tasks sum them. Sums over batches are in double precision, so a model, and a score, does not
depend on how the rows lie in partitions, but for the rounding of float32 within a batch.

**Scoring.** Windows of 32 ids overlap by half: each block of 16 is scored once, by queries that see their own block up to
themselves and the block before. Blocks of many texts go through the attention as one masked batch.

Defined results: NULL and empty texts are one end. Rows with a NULL id are trained on (``held_out`` is false). Repeated
rows score alike, to the rounding of float32. With no training text at all every word is unknown and classes are equally likely.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.llm.quality_classifier import fold
from wattloom.llm.storage import Scratch, write_table
from wattloom.llm.text import Slice, signed, slices
from wattloom.llm.tokenizers import BYTE_BPE, END, IDS, byte_bpe
from wattloom.shared import scratch_path

COMMON = 200_000
TRAINING_DOCUMENTS, TRAINING_WINDOWS = 400, 6_000
ROUNDS = 16
RATE, LAST_RATE = 0.01, 0.002  # of the first and the last round
SINGLE, SHARED = 960, 64  # classes of one id, and of many
MEMBERS = 32  # classes of a group
BLOCK, WIDTH = 16, 16
_AT_ONCE = 2048  # blocks of a batch
_TOGETHER = 1024  # targets of a group that are predicted together
_SUMMING = 16
_CACHED_WORDS = 600_000
_LARGEST = 60.0  # of a logit, so that sums of exponentials need no shift
END_WORD = np.uint64(0x243F6A8885A308D3)  # stands for the end among word hashes


_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32


def joined_words(words: Slice, which: np.ndarray) -> str:
    """Some words, A-Z in lower case, each with a blank before it."""
    starts, sizes = words.starts[which], words.ends[which] - words.starts[which]
    ends = np.cumsum(sizes + 1)
    out = np.full(int(ends[-1]), 0x20, np.uint8)
    within = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(ends - sizes, sizes) + within] = _lower[words.bytes[np.repeat(starts, sizes) + within]]
    return out.tobytes().decode()


class Encoder:
    """Subword ids of whole slices; words not met before are encoded together, and remembered."""

    def __init__(self, path: str):
        self.bpe = byte_bpe(path)
        self.starts_word = np.array([self.bpe.decode_single_token_bytes(i)[:1] == b" " for i in range(self.bpe.n_vocab)] + [False] * (IDS - self.bpe.n_vocab))
        self._forget()

    def _forget(self) -> None:
        self.keys, self.places = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.ids, self.begins, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _pieces(self, joined: str, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of ``n`` words with a blank before each, and how many each has. A blank starts a token, so joined words fall apart again
        there; where blanks of other kinds in a word hide that, the words are encoded one by one."""
        ids = np.array(self.bpe.encode_ordinary(joined), np.int32)
        starts = np.flatnonzero(self.starts_word[ids])
        if len(starts) == n:
            return ids, np.diff(np.append(starts, len(ids)))
        each = [self.bpe.encode_ordinary(" " + t) for t in joined[1:].split(" ")]
        sizes = np.fromiter(map(len, each), np.int64, len(each))
        return np.fromiter(chain.from_iterable(each), np.int32, int(sizes.sum())), sizes

    def __call__(self, words: Slice, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids with an end after each row, and the number of ids of each row."""
        distinct, first, at = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) > _CACHED_WORDS:
            self._forget()
        found = np.searchsorted(self.keys, distinct)
        place = np.append(self.places, -1)[found]
        place[np.append(self.keys, 0)[found] != distinct] = -1
        new = np.flatnonzero(place < 0)
        if len(new):
            pieces = [self._pieces(joined_words(words, first[some]), len(some)) for some in np.split(new, range(4096, len(new), 4096))]
            ids, sizes = (np.concatenate(x) for x in zip(*pieces))
            place[new] = np.arange(len(new)) + len(self.keys)
            self.keys, self.places = np.insert(self.keys, found[new], distinct[new]), np.insert(self.places, found[new], place[new])
            self.begins = np.append(self.begins, np.cumsum(sizes) - sizes + len(self.ids))
            self.sizes, self.ids = np.append(self.sizes, sizes), np.append(self.ids, ids)
        n, begins = self.sizes[place][at] if len(at) else np.zeros(0, np.int64), self.begins[place] if len(at) else np.zeros(0, np.int64)
        total = np.bincount(words.row, n, words.rows).astype(np.int64) + 1
        out = np.full(int(total.sum()), END, np.int64)
        ends = np.cumsum(n)
        within = np.arange(int(n.sum())) - np.repeat(ends - n, n)
        out[np.arange(len(within)) + np.repeat(words.row, n)] = self.ids[np.repeat(begins[at], n) + within]
        return out, total


@dataclass
class Classes:
    """The class of each id, and log P(id | class)."""

    of: np.ndarray
    log_share: np.ndarray
    n: int


def make_classes(counts: np.ndarray) -> Classes:
    order = np.argsort(-counts, kind="stable")
    order = np.concatenate([[END], order[order != END]])
    of = np.empty(IDS, np.int64)
    of[order[:SINGLE]] = np.arange(SINGLE)
    rest = order[SINGLE:]
    mass = np.cumsum(counts[rest] + 0.5)
    of[rest] = SINGLE + np.minimum((mass - 0.25) / mass[-1] * SHARED, SHARED - 1).astype(np.int64)
    weight = counts + 0.5
    return Classes(of, np.log(weight / np.bincount(of, weight, SINGLE + SHARED)[of]), SINGLE + SHARED)


def blocks(classes: np.ndarray, sizes: np.ndarray, n_classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Targets (blocks, BLOCK) with -1 after a text's end; inputs (the class before each target; ``n_classes`` at a start); whether a
    block is its text's first."""
    per_row = -(-sizes // BLOCK)
    first_block = np.cumsum(per_row) - per_row
    begin = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) - np.repeat(begin, sizes)
    cell = np.repeat(first_block * BLOCK, sizes) + place
    targets = np.full(int(per_row.sum()) * BLOCK, -1, np.int64)
    targets[cell] = classes
    inputs = np.full(len(targets), n_classes, np.int64)
    inputs[cell[1:]] = np.where(place[1:] > 0, classes[:-1], n_classes)
    first = np.zeros(int(per_row.sum()), bool)
    first[first_block] = True
    return targets.reshape(-1, BLOCK), inputs.reshape(-1, BLOCK), first


_key, _query = np.arange(2 * BLOCK)[:, None], np.arange(BLOCK)[None, :] + BLOCK
_distance = np.clip(_query - _key, 0, 2 * BLOCK - 1)
_unseen = _key > _query


class Adam:
    """The running moments of gradients."""

    def __init__(self):
        self.m, self.s, self.t = {}, {}, 0

    def step(self, weights: dict[str, np.ndarray], gradients: dict[str, np.ndarray], rate: float) -> None:
        self.t += 1
        for name, g in gradients.items():
            self.m[name] = 0.9 * self.m.get(name, 0) + 0.1 * g
            self.s[name] = 0.99 * self.s.get(name, 0) + 0.01 * g * g
            step = (self.m[name] / (1 - 0.9**self.t)) / (np.sqrt(self.s[name] / (1 - 0.99**self.t)) + 1e-8)
            weights[name] -= (rate * step).astype(np.float32)


def keep_memory() -> None:
    """Let this process keep freed memory: batches need the same few megabytes again and again, and new pages cost more than sums."""
    c = ctypes.CDLL(None)
    if hasattr(c, "mallopt"):
        c.mallopt(-3, 1 << 26)  # M_MMAP_THRESHOLD
        c.mallopt(-1, 1 << 27)  # M_TRIM_THRESHOLD


def add_by_class(out: np.ndarray, classes: np.ndarray, values: np.ndarray) -> None:
    """Add each row of ``values`` to the row of ``out`` that its class names."""
    cells = np.arange(out.size).reshape(out.shape).take(classes, axis=0)
    out += np.bincount(cells.ravel(), values.ravel(), out.size).reshape(out.shape)


def bounded(z: np.ndarray) -> np.ndarray:
    """``z`` with its logits held within ``_LARGEST``; few are beyond, and to look costs less than to write."""
    return np.clip(z, -_LARGEST, _LARGEST, out=z) if z.max() > _LARGEST or z.min() < -_LARGEST else z


class Attention:
    """One head of causal self-attention over class ids, with residual and a softmax in two steps; float32."""

    def __init__(self, n_classes: int, members: int = MEMBERS, seed: int = 7):
        rng, groups = np.random.default_rng(seed), n_classes // members
        draw = lambda *s, scale=0.1: rng.normal(0, scale, s).astype(np.float32)
        self.weights = {
            "embed": draw(n_classes + 1, WIDTH, scale=0.3), "query": draw(WIDTH, WIDTH, scale=0.25), "key": draw(WIDTH, WIDTH, scale=0.25),
            "value": draw(WIDTH, WIDTH, scale=0.25), "near": np.zeros(2 * BLOCK, np.float32), "group": draw(WIDTH, groups), "group_bias": np.zeros(groups, np.float32),
            "member": draw(groups, WIDTH, members), "member_bias": np.zeros((groups, members), np.float32),
        }

    def _hear(self, inputs: np.ndarray, before: np.ndarray, first: np.ndarray, in_order: bool = False) -> tuple:
        """What is known at each place of (blocks, BLOCK) inputs, with the inputs of the block before (not seen where ``first``).

        Inputs are few classes, so their products with the weights are looked up; ``in_order`` says that each block but the first has the
        one above before it, so keys and values are looked up once for both. Attention has a row for each key and a column for each query,
        and is divided by its sums last: every value has a 1 behind it that adds them up. So has what is known, for the biases.
        """
        w, scale = self.weights, np.float32(1 / np.sqrt(WIDTH))
        ones = np.ones((len(w["embed"]), 1), np.float32)
        heard = np.concatenate([w["embed"] @ w["key"], w["embed"] @ w["value"], ones], axis=1)
        if in_order:
            seen = np.concatenate([before[:1], inputs])
            others = sliding_window_view(heard.take(seen.ravel(), axis=0), 2 * BLOCK, axis=0)[::BLOCK].transpose(0, 2, 1)
        else:
            seen = np.concatenate([before, inputs], axis=1)
            others = heard.take(seen, axis=0)
        own = np.concatenate([w["embed"] @ w["query"] * scale, w["embed"], ones], axis=1).take(inputs, axis=0)
        q, k, v, h = own[..., :WIDTH], others[..., :WIDTH], others[..., WIDTH:], own[..., WIDTH:]
        a = k @ np.ascontiguousarray(q.transpose(0, 2, 1))
        a = bounded(a)
        a += np.where(_unseen, np.float32(-1e9), w["near"][_distance])
        np.exp(a, out=a)
        a[first, :BLOCK] = 0
        o = a.transpose(0, 2, 1) @ v
        share = 1 / o[..., WIDTH:]
        o = o[..., :WIDTH] * share
        h[..., :WIDTH] += o
        return seen, q, k, v, a, share, o, h

    def _predict(self, h: np.ndarray, target: np.ndarray, sums: dict[str, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """log P of each target after ``h``, 0 for a target of -1; with ``sums`` also adds the gradients of -log P there, and returns those
        of ``h`` (without its 1). Targets of a group are taken together, so that one product gives both steps of the softmax."""
        w = self.weights
        groups, members = w["member_bias"].shape
        group = (target // members).astype(np.int16)
        order = np.argsort(group, kind="stable")
        h, member = h.take(order, axis=0), target.take(order) % members + groups
        bounds = np.searchsorted(group.take(order), np.arange(groups + 1))
        each = np.empty((groups + members, WIDTH + 1), np.float32)
        each[:groups, :WIDTH], each[:groups, WIDTH] = w["group"].T, w["group_bias"]
        step = np.repeat(np.eye(2, dtype=np.float32), [groups, members], axis=1)
        log_p, rows = np.zeros(len(h)), np.arange(_TOGETHER)
        if sums is not None:
            dh, by_group = np.zeros((len(h), WIDTH), np.float32), np.zeros((groups, WIDTH + 1))
        for g in np.flatnonzero(np.diff(bounds)).tolist():
            each[groups:, :WIDTH], each[groups:, WIDTH] = w["member"][g].T, w["member_bias"][g]
            for a in range(bounds[g], bounds[g + 1], _TOGETHER):
                here = slice(a, min(a + _TOGETHER, bounds[g + 1]))
                z = bounded(each @ h[here].T)  # a column for each target
                own = member[here], rows[: z.shape[1]]
                picked = z[g] + z[own]
                np.exp(z, out=z)
                total = step @ z
                log_p[here] = picked - np.log(total[0] * total[1])
                if sums is not None:
                    np.reciprocal(total, out=total)
                    z[:groups] *= total[0]
                    z[groups:] *= total[1]
                    z[g] -= 1
                    z[own] -= 1
                    np.matmul(z.T, each[:, :WIDTH], out=dh[here])
                    found = z @ h[here]
                    by_group += found[:groups]
                    sums["member"][g] += found[groups:, :WIDTH].T
                    sums["member_bias"][g] += found[groups:, WIDTH]
        if sums is not None:
            sums["group"] += by_group[:, :WIDTH].T
            sums["group_bias"] += by_group[:, WIDTH]
        out = np.empty_like(log_p)
        out[order] = log_p
        if sums is None:
            return out, None
        back = np.empty_like(dh)
        back[order] = dh
        return out, back

    def log_probabilities(self, targets: np.ndarray, inputs: np.ndarray, first: np.ndarray) -> np.ndarray:
        """log P of each target, in the targets' shape; 0 where there is none."""
        out = np.zeros(targets.shape)
        for a in range(0, len(targets), _AT_ONCE):
            part = slice(a, a + _AT_ONCE)
            h = self._hear(inputs[part], inputs[max(a - 1, 0) :][:1], first[part], True)[-1]
            out[part] = self._predict(h.reshape(-1, WIDTH + 1), targets[part].ravel())[0].reshape(-1, BLOCK)
        return out

    def no_sums(self) -> dict[str, np.ndarray]:
        """Sums over no windows: loss, targets and windows; gradients of the weights."""
        return {"told": np.zeros(3)} | {name: np.zeros(w.shape) for name, w in self.weights.items()}

    def add_gradients(
        self, sums: dict[str, np.ndarray], targets: np.ndarray, inputs: np.ndarray, before: np.ndarray, first: np.ndarray, in_order: bool = False
    ) -> None:
        """Add the gradients of the targets' -log P; ``in_order`` says that each block but the first has the one above before it.

        Nothing is heard of the block before where ``first``, so its gradients are 0 there. With ``in_order`` a place that is heard in its
        own block and in the next has one row for both.
        """
        w, n = self.weights, len(inputs)
        seen, q, k, v, a, share, o, h = self._hear(inputs, before, first, in_order)
        log_p, dh = self._predict(h.reshape(-1, WIDTH + 1), targets.ravel(), sums)
        sums["told"] += [-log_p.sum(), np.count_nonzero(targets >= 0), n]
        do = np.empty((n * BLOCK, WIDTH + 1), np.float32)
        do[:, :WIDTH], do[:, WIDTH] = dh, (dh * o.reshape(-1, WIDTH)) @ np.full(WIDTH, -1, np.float32)
        do = do.reshape(n, BLOCK, WIDTH + 1)
        do *= share
        da = v @ np.ascontiguousarray(do.transpose(0, 2, 1))
        da *= a
        sums["near"] += np.bincount(_distance.ravel(), np.ones(n, np.float32) @ da.reshape(n, -1), 2 * BLOCK)

        def heard(x: np.ndarray) -> np.ndarray:
            """A row for each of ``seen``: with ``in_order``, the sum of what a place's own block and the next hear of it."""
            if in_order:
                x, later = np.concatenate([x[:1, :BLOCK], x[:, BLOCK:]]), x[1:, :BLOCK]
                x[1:-1] += later
            return x.reshape(-1, WIDTH)

        dq = (da.transpose(0, 2, 1) @ k).reshape(-1, WIDTH) * np.float32(1 / np.sqrt(WIDTH))
        dk, dv = heard(da @ q), heard(a @ do[..., :WIDTH])  # q is scaled already
        x, embed = w["embed"].take(seen.ravel(), axis=0), dk @ w["key"].T + dv @ w["value"].T
        own = np.s_[BLOCK:] if in_order else np.arange(len(x)).reshape(n, -1)[:, BLOCK:].ravel()
        for name, heard_by, d in (("query", x[own], dq), ("key", x, dk), ("value", x, dv)):
            sums[name] += heard_by.T @ d
        embed[own] += dh + dq @ w["query"].T
        add_by_class(sums["embed"], seen.ravel(), embed)

    def gradients(self, sums: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        """Gradients of the mean -log P over all targets that were summed."""
        return {name: sums[name] / max(1.0, sums["told"][1]) for name in self.weights}

    def train(self, targets: np.ndarray, inputs: np.ndarray, before: np.ndarray, first: np.ndarray, steps: int = 500, batch: int = 64, rate: float = 0.01, seed: int = 7) -> None:
        """Adam steps on random batches of windows, the rate falling to a tenth."""
        if not len(targets):
            return
        rng, adam = np.random.default_rng(seed), Adam()
        for t in range(1, steps + 1):
            pick, sums = rng.integers(0, len(targets), batch), self.no_sums()
            self.add_gradients(sums, targets[pick], inputs[pick], before[pick], first[pick])
            adam.step(self.weights, self.gradients(sums), rate * (1 - 0.9 * t / steps))


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(key, n): the count of each word hash, and of ``END_WORD`` for ends."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends, held = 0, 0
        pending: list[tuple[np.ndarray, np.ndarray]] = []

        def rows(keys: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
            for a in range(0, len(keys), 100_000):
                yield pa.RecordBatch.from_arrays([signed(keys[a : a + 100_000]), pa.array(n[a : a + 100_000])], ["key", "n"])

        def merged() -> tuple[np.ndarray, np.ndarray]:
            keys, at = np.unique(np.concatenate([k for k, _ in pending]), return_inverse=True)
            return keys, np.bincount(at, np.concatenate([n for _, n in pending]), len(keys)).astype(np.int64)

        for _, words in slices(parts, "text"):
            ends += words.rows
            pending.append(np.unique(words.hashes(fold_case=True), return_counts=True))
            held += len(pending[-1][0])
            if held > 1_500_000:
                pending = [merged()]
                held = len(pending[0][0])
                if held > 1_000_000:
                    yield from rows(*pending[0])
                    pending, held = [], 0
        if pending:
            yield from rows(*merged())
        if ends:
            yield from rows(np.array([END_WORD]), np.array([ends]))

    counted = docs.select(F.col(text).alias("text")).mapInArrow(run, "key bigint, n bigint")
    return counted.groupBy("key").agg(F.sum("n").alias("n"))


def encoded(keyed: DataFrame, path: str) -> DataFrame:
    """(row, id, part, ids): the subword ids of each row of ``keyed`` (row, id, part, text)."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(path)
        for rows, words in slices(parts, "text"):
            ids, sizes = encode(words, words.hashes(fold_case=True))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*rows.columns[:3], lists], ["row", "id", "part", "ids"])

    return keyed.select("row", "id", "part", "text").mapInArrow(run, "row bigint, id bigint, part int, ids array<int>")


def sequences(parts: Iterator[pa.RecordBatch], column: str = "ids", at_once: int = 400_000) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Batches cut into runs of rows of about ``at_once`` ids (one row at least), with their ids and the number of each row."""
    for part in parts:
        if not part.num_rows:
            continue
        lists = part.column(part.schema.get_field_index(column))
        bounds, at = lists.offsets.to_numpy(), 0
        while at < part.num_rows:
            stop = max(at + 1, int(np.searchsorted(bounds, bounds[at] + at_once, "right")) - 1)
            yield part.slice(at, stop - at), lists.values.slice(bounds[at], bounds[stop] - bounds[at]).to_numpy().astype(np.int64), np.diff(bounds[at : stop + 1]).astype(np.int64)
            at = stop


def id_counts(texts: DataFrame) -> np.ndarray:
    """How often each subword id is found."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(IDS, np.int64)
        for _, ids, _ in sequences(parts):
            total += np.bincount(ids, minlength=IDS)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["key", "n"])

    counts = texts.select("ids").mapInArrow(run, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n")).toPandas()
    per_id = np.zeros(IDS)
    per_id[counts["key"].to_numpy(np.int64)] = counts["n"].to_numpy(np.float64)
    return per_id


@dataclass
class Scorer:
    """What is sent to the tasks: bounded tables and the model."""

    classes: Classes
    model: Attention
    keys: np.ndarray
    logs: np.ndarray


def training_windows(texts: DataFrame, classes: Classes) -> tuple[np.ndarray, ...]:
    """For the start: at most ``TRAINING_WINDOWS`` windows of the ``TRAINING_DOCUMENTS`` texts with the smallest row hashes."""
    last = texts.select("row").distinct().orderBy("row").limit(TRAINING_DOCUMENTS).agg(F.max("row")).first()[0]
    some = texts.where(F.col("row") <= last).dropDuplicates(["row"]) if last is not None else texts

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, ids, sizes in sequences(parts):
            targets, inputs, first = blocks(classes.of[ids], sizes, classes.n)
            before = inputs[np.maximum(np.arange(len(inputs)) - 1, 0)]
            whole = np.concatenate([targets, inputs, before, first[:, None]], axis=1).astype(np.int16)
            for a in range(0, len(whole), 5_000):
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(whole[a : a + 5_000]) + 1) * whole.shape[1], pa.int32()), pa.array(whole[a : a + 5_000].ravel()))
                yield pa.RecordBatch.from_arrays([lists], ["window"])

    windows = some.select("ids").mapInArrow(run, "window array<smallint>").orderBy(F.xxhash64("window"), "window").limit(TRAINING_WINDOWS)
    got = np.array([r.window for r in windows.collect()], np.int64).reshape(-1, 3 * BLOCK + 1)
    return got[:, :BLOCK], got[:, BLOCK : 2 * BLOCK], got[:, 2 * BLOCK : 3 * BLOCK], got[:, -1] > 0


def summed(rows: DataFrame) -> np.ndarray | None:
    """The sum of equally long arrays (total); ``_SUMMING`` tasks sum those of all others, the driver theirs."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for part in parts:
            for i in range(part.num_rows):
                one = part.column(0)[i].values.to_numpy()
                total = one.copy() if total is None else total + one
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], ["total"])

    sums = rows.repartition(_SUMMING).mapInArrow(run, "total array<double>").toArrow()["total"]
    arrays = [x.values.to_numpy() for x in sums]
    return sum(arrays[1:], arrays[0]) if arrays else None


def fit(texts: DataFrame, classes: Classes) -> tuple[Attention, int]:
    """The attention model trained on all windows of ``texts`` (row, part, ids), and how many windows those were."""
    spark, model, adam, windows = texts.sparkSession, Attention(classes.n), Adam(), 0
    model.train(*training_windows(texts, classes))
    for part in range(ROUNDS):
        sent = spark.sparkContext.broadcast((classes, model))

        def run(parts: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            classes, model = sent.value
            keep_memory()
            sums = model.no_sums()
            for _, ids, sizes in sequences(parts):
                targets, inputs, first = blocks(classes.of[ids], sizes, classes.n)
                for a in range(0, len(targets), _AT_ONCE):
                    here = slice(a, a + _AT_ONCE)
                    model.add_gradients(sums, targets[here], inputs[here], inputs[max(a - 1, 0) :][:1], first[here], True)
            if sums["told"][1]:
                flat = np.concatenate([g.ravel() for g in sums.values()])
                yield pa.RecordBatch.from_arrays([pa.array([flat], pa.list_(pa.float64()))], ["total"])

        total = summed(texts.where(F.col("part") == part).select("ids").mapInArrow(run, "total array<double>"))
        if total is not None:
            sums, at = model.no_sums(), 0
            for name, g in sums.items():
                sums[name] = total[at : at + g.size].reshape(g.shape)
                at += g.size
            adam.step(model.weights, model.gradients(sums), RATE + (LAST_RATE - RATE) * part / max(1, ROUNDS - 1))
            windows += round(sums["told"][2])
        sent.unpersist()
    return model, windows


def row_key(id_column: str, text: str) -> Column:
    return F.xxhash64(id_column, text)


def score(docs: DataFrame, held_out_fold: int = 1, path: str = BYTE_BPE, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score): one row for each row of ``docs``."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    held_out = F.coalesce(fold(F.col("id")) == held_out_fold, F.lit(False))
    narrow = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text).alias("text"))
    words = scratch.stored(word_counts(narrow.where(~held_out)), "word-counts")
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    n, v = int(total.n), int(total.v)
    ends = words.where(F.col("key") == int(np.array([END_WORD]).view(np.int64)[0])).first()
    end_count = int(ends.n) if ends else 0
    common = words.orderBy(F.desc("n"), "key").limit(COMMON).toPandas()
    keys = common["key"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    keyed = narrow.select(row_key("id", "text").alias("row"), "id", "text")
    part = F.when(held_out, F.lit(ROUNDS)).otherwise(F.pmod("row", F.lit(ROUNDS))).cast("int")
    ids_path = write_table(encoded(keyed.withColumn("part", part), path), scratch_path(spark, "subwords"), "part")
    texts = spark.read.schema("row bigint, id bigint, ids array<int>, part int").parquet(ids_path)
    training = texts.where(F.col("part") < ROUNDS)
    classes = make_classes(id_counts(training))
    model, _ = fit(training, classes)
    floor = np.log10(n + 0.5 * (v + 1))
    scorer = spark.sparkContext.broadcast(Scorer(classes, model, keys[order], np.log10(common["n"].to_numpy(np.float64)[order] + 0.5)))

    def base(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = scorer.value
        for rows, cut in slices(parts, "text"):
            h = cut.hashes(fold_case=True)
            at = np.minimum(np.searchsorted(s.keys, h), max(len(s.keys) - 1, 0))
            is_common = s.keys[at] == h if len(s.keys) else np.zeros(len(h), bool)
            known = np.bincount(cut.row[is_common], minlength=cut.rows) + (end_count > 0)
            sums = np.bincount(cut.row[is_common], s.logs[at[is_common]], cut.rows) + np.log10(end_count + 0.5)
            row, h = cut.row[~is_common], h[~is_common]
            in_order = np.lexsort((h, row))
            row, h = row[in_order], h[in_order]
            new = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (h[1:] != h[:-1])]) if len(h) else [])
            times = np.diff(np.append(new, len(h)))
            names, none = rows.column(0).to_numpy(), np.zeros(cut.rows, np.int64)
            # a row of 0 times is the document itself: what its common words give, and how often the document is repeated
            left = [names[row[new]], h[new].view(np.int64), times, *(pa.nulls(len(new), t) for t in (pa.int64(), pa.int64(), pa.float64()))]
            whole = [names, names, none, cut.n_words + 1, known, sums]
            for columns in (left, whole):
                for a in range(0, len(columns[0]), 100_000):
                    yield pa.RecordBatch.from_arrays([pa.array(c[a : a + 100_000]) for c in columns], ["row", "key", "times", "n_tokens", "known", "sums"])

    def attention(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = scorer.value
        keep_memory()
        for rows, ids, sizes in sequences(parts):
            targets, inputs, first = blocks(s.classes.of[ids], sizes, s.classes.n)
            per_block = s.model.log_probabilities(targets, inputs, first).sum(1)
            subword = np.add.reduceat(s.classes.log_share[ids], np.cumsum(sizes) - sizes)
            score = (np.add.reduceat(per_block, np.flatnonzero(first)) + subword) / np.log(10)
            yield pa.RecordBatch.from_arrays([*rows.columns[:2], pa.array(score)], ["row", "id", "score"])

    counted = keyed.select("row", "text").mapInArrow(base, "row bigint, key bigint, times bigint, n_tokens bigint, known bigint, sums double")
    found = counted.join(words.withColumnRenamed("n", "c"), "key", "left")
    times, c = F.col("times"), F.coalesce("c", F.lit(0))
    per_row = found.groupBy("row").agg(
        F.sum(times * F.log10(c + F.lit(0.5))).alias("_rare"), F.sum(F.when(c > 0, times).otherwise(F.lit(0))).alias("_known"),
        F.sum((times == 0).cast("long")).alias("_copies"), *(F.max(name).alias(name) for name in ("n_tokens", "known", "sums")),
    )
    scored = texts.select("row", "id", "ids").mapInArrow(attention, "row bigint, id bigint, score double")
    return scored.join(per_row, "row").select(
        "id", held_out.alias("held_out"), "n_tokens", (F.col("known") + (F.col("_known") / F.col("_copies")).cast("long")).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("sums") + F.col("_rare") / F.col("_copies") - F.col("n_tokens") * F.lit(float(floor))).alias("base_score"), "score",
    )
