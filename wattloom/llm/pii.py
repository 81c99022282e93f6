"""Personal data: fixed patterns, and a character-level bidirectional LSTM with CRF transitions.

**Base.** Four kinds (``KINDS``) by pattern, leftmost and non-overlapping per kind, then checked (``valid``); matches that fail are
dropped. Searches are written so that no text, however long or odd, takes more than linear time.

**Tagger.** A two-way LSTM over characters gives scores for outside / begin / inside of each kind; CRF transitions tie neighbouring
tags. It is trained in numpy on labelled spans that the patterns do not see: base spans, written another way within their texts (``rewritten``:
"at" and "dot" as words or in brackets, numbers with strokes, wider gaps or no plus), beside the same texts as they were and windows of texts
without any span. At most ``TRAINING_WINDOWS`` of each come from at most ``TRAINING_DOCUMENTS`` documents (those with the smallest hash of their id).

**Windows.** Every span of these kinds, however written, holds a digit, an at sign, or "at" or "dot" as a word of its own, so whatever lies
further than ``MARGIN`` characters from one is outside by definition. The stretches around them, over whole texts, are cut into windows that overlap
by half, so a span of up to half a window is whole in some window. A span that touches a
cut edge is left to the neighbouring window. Of all spans decoded in a text, those that do not overlap and
have the highest total log-odds are chosen by dynamic programming. Base spans stay; tagged spans must not overlap them, nor stretches that
a pattern matched and its check refused, and need log-odds of ``LEAST_ODDS`` or more.

Defined results: NULL texts are empty and have no spans. Repeated rows are treated alike. Without a single labelled span in the
sample the tagger adds nothing.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
TRAINING_DOCUMENTS, TRAINING_WINDOWS = 8_000, 1_500
WINDOW, MARGIN = 128, 40
LEAST_ODDS = 6.0
HIDDEN = 12
TAGS = 1 + 2 * len(KINDS)  # 0 outside; 1 + 2k begins kind k; 2 + 2k goes on with it
SYMBOLS = 98
_SLICE = 2 << 20

_local = re.compile(r"[A-Za-z0-9._%+-]*\Z")
_domain = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_local_reversed = re.compile(r"[A-Za-z0-9._%+-]*")
# a match can only begin where a run of digits does: from a later digit the same text would follow
_ip = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_card = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
_phone = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_trigger = re.compile(r"[0-9@]|(?<![A-Za-z])(?:at|dot)(?![A-Za-z])", re.IGNORECASE)

Span = tuple[int, int, int]  # start, end, kind


def emails(text: str) -> list[tuple[int, int]]:
    """The pattern ``local@label(.label)+``, found from its at signs."""
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end:  # back over the local part, in steps, never past the match before
            step = max(end, start - 64)
            run = _local_reversed.match(text[step:start][::-1]).end()
            start -= run
            if run < at - step and start > step:
                break
            if run == 0:
                break
        domain = _domain.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            found.append((start, end))
        at = text.find("@", max(at + 1, end))
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def valid(kind: int, match: str) -> bool:
    if kind == 1:
        return all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in match.split("."))
    digits = re.sub("[^0-9]", "", match) if kind > 1 else ""
    if kind == 2:
        return 14 <= len(digits) <= 19 and luhn(digits)
    if kind == 3:
        return 10 <= len(digits) <= 15
    return True


def base_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Spans in order of start and kind, and the matches that were refused. A number too short for a card says nothing, so it is neither."""
    kept, refused = [(a, b, 0) for a, b in emails(text)], []
    for kind, pattern in ((1, _ip), (2, _card), (3, _phone)):
        for m in pattern.finditer(text):
            if valid(kind, m.group()):
                kept.append((m.start(), m.end(), kind))
            elif kind != 2 or sum(map(str.isdigit, m.group())) >= 14:
                refused.append((m.start(), m.end(), kind))
    return sorted(kept, key=lambda s: (s[0], s[2])), refused


def _written_out(match: str, kind: int) -> str:
    """The same personal data as people write it to hide it, or out of habit; which way depends on the match alone."""
    way = zlib.crc32(match.encode())
    if kind == 0:
        local, _, domain = match.partition("@")
        at, dot = ((" (at) ", " (dot) "), (" at ", " dot "), ("[at]", "."), (" [at] ", " [dot] "), (" AT ", "."), ("(at)", "(dot)"))[way % 6]
        return local + at + domain.replace(".", dot)
    if kind == 1:
        return match.replace(".", ("[.]", " . ")[way % 2])
    parts = re.findall("[0-9]+", match)
    if kind == 2:
        digits = "".join(parts)
        return ("/", "_", "  ", " / ")[way % 4].join(digits[i : i + 4] for i in range(0, len(digits), 4))
    if len(parts) == 1:
        parts = [parts[0][:2], parts[0][2:5], parts[0][5:]]
    return (("00", "/"), ("", "/"), ("00", " / "), ("0", "/"))[way % 4][0] + (("/", "/", " / ", "/")[way % 4]).join(p for p in parts if p)


def rewritten(text: str, spans: list[Span]) -> tuple[str, list[Span]]:
    """The text with its spans written another way, and where they are then; of overlapping spans only the first stays one."""
    out, moved, end, at = [], [], 0, 0
    for a, b, kind in spans:
        if a >= end:
            out += [text[end:a], _written_out(text[a:b], kind)]
            at += a - end
            moved.append((at, at + len(out[-1]), kind))
            at += len(out[-1])
            end = b
    return "".join(out) + text[end:], moved


def codes_of(text: str) -> np.ndarray:
    """One symbol a code point: 1-95 printable ASCII, 96 other ASCII, 97 the rest."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    return np.where(points > 126, 97, np.where(points < 32, 96, points - 31))


def windows_of(codes: np.ndarray) -> list[tuple[int, int, bool, bool]]:
    """(start, end, cut at the start, cut at the end) of all windows around digits, at signs and written-out ones."""
    plain = np.where(codes < 96, codes + 31, 1).astype(np.uint8).tobytes().decode("latin-1")
    hits = np.array([m.start() for m in _trigger.finditer(plain)], np.int64)
    out = []
    if not len(hits):
        return out
    breaks = np.flatnonzero(np.diff(hits) > 2 * MARGIN)
    for a, b in zip(hits[np.append(0, breaks + 1)], hits[np.append(breaks, len(hits) - 1)]):
        low, high = max(0, int(a) - MARGIN), min(len(codes), int(b) + 1 + MARGIN)
        start = low
        while True:
            end = min(start + WINDOW, high)
            out.append((start, end, start > low, end < high))
            if end == high:
                break
            start += WINDOW // 2
    return out


def tags_of(spans: list[Span], start: int, end: int) -> np.ndarray:
    tags = np.zeros(WINDOW, np.int8)
    for a, b, kind in spans:
        if a < end and b > start:
            tags[max(a, start) - start : min(b, end) - start] = 2 + 2 * kind
            if a >= start:
                tags[a - start] = 1 + 2 * kind
    return tags


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


class Tagger:
    """Two-way character LSTM with CRF transitions; windows are (rows, WINDOW) symbols, 0 past the end."""

    def __init__(self, seed: int = 7):
        rng, h = np.random.default_rng(seed), HIDDEN
        draw = lambda *s, scale: rng.normal(0, scale, s).astype(np.float32)
        self.weights = {
            "symbol": draw(2, SYMBOLS, 4 * h, scale=0.3), "recur": draw(2, h, 4 * h, scale=0.25), "out": draw(2 * h, TAGS, scale=0.2),
            "bias": np.zeros(TAGS, np.float32), "next": np.zeros((TAGS, TAGS), np.float32),
        }
        self.weights["symbol"][:, :, h : 2 * h] += 0.5
        tag = np.arange(TAGS)
        inside = (tag > 0) & (tag % 2 == 0)
        self.barred = inside[None, :] & (tag[:, None] != tag[None, :]) & (tag[:, None] != tag[None, :] - 1)  # inside needs its own kind before

    def _lstm(self, codes: np.ndarray) -> tuple:
        w, (n, length), h = self.weights, codes.shape, HIDDEN
        both = np.stack([codes, codes[:, ::-1]])
        alive = (both > 0).astype(np.float32)
        state, cell = np.zeros((2, n, h), np.float32), np.zeros((2, n, h), np.float32)
        gates, cells, states = np.empty((length, 2, n, 4 * h), np.float32), np.empty((length + 1, 2, n, h), np.float32), np.empty((length + 1, 2, n, h), np.float32)
        cells[0], states[0] = cell, state
        for t in range(length):
            g = np.stack([w["symbol"][0][both[0, :, t]], w["symbol"][1][both[1, :, t]]]) + state @ w["recur"]
            g[..., : 3 * h] = _sigmoid(g[..., : 3 * h])
            g[..., 3 * h :] = np.tanh(g[..., 3 * h :])
            on = alive[:, :, t, None]
            cell = (g[..., h : 2 * h] * cell + g[..., :h] * g[..., 3 * h :]) * on
            state = g[..., 2 * h : 3 * h] * np.tanh(cell) * on
            gates[t], cells[t + 1], states[t + 1] = g, cell, state
        joined = np.concatenate([states[1:, 0], states[:0:-1, 1]], axis=-1).transpose(1, 0, 2)
        return both, alive, gates, cells, states, joined

    def emissions(self, codes: np.ndarray) -> tuple[np.ndarray, tuple]:
        """Scores (rows, WINDOW, TAGS); past the end only outside is open."""
        kept = self._lstm(codes)
        scores = kept[-1] @ self.weights["out"] + self.weights["bias"]
        ended = codes == 0
        scores[ended] = -1e4
        scores[ended, 0] = 0
        return scores, kept

    def _transitions(self) -> np.ndarray:
        return np.where(self.barred, np.float32(-1e4), self.weights["next"])

    def gradients(self, codes: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of the tag sequences, and its gradients (forward-backward, then through time)."""
        w, (n, length), h = self.weights, codes.shape, HIDDEN
        scores, (both, alive, gates, cells, states, joined) = self.emissions(codes)
        move = self._transitions()
        ahead, back = np.empty(scores.shape), np.zeros(scores.shape)
        ahead[:, 0] = scores[:, 0] + np.where(np.arange(TAGS) % 2 == 0, np.where(np.arange(TAGS) == 0, 0.0, -1e4), 0.0)
        for t in range(1, length):
            ahead[:, t] = scores[:, t] + _log_sum(ahead[:, t - 1, :, None] + move, 1)
        for t in range(length - 2, -1, -1):
            back[:, t] = _log_sum(move[None] + (scores[:, t + 1] + back[:, t + 1])[:, None, :], 2)
        total = _log_sum(ahead[:, -1], 1)
        d_scores = np.exp(ahead + back - total[:, None, None])
        rows = np.arange(n)
        d_next = np.zeros((TAGS, TAGS))
        gold = ahead[rows, 0, tags[:, 0]].copy()
        for t in range(length):
            d_scores[rows, t, tags[:, t]] -= 1
            if t:
                pair = np.exp(ahead[:, t - 1, :, None] + move + (scores[:, t] + back[:, t])[:, None, :] - total[:, None, None])
                d_next += pair.sum(0)
                np.add.at(d_next, (tags[:, t - 1], tags[:, t]), -1)
                gold += move[tags[:, t - 1], tags[:, t]] + scores[rows, t, tags[:, t]]
        d_scores = (np.where((codes > 0)[..., None], d_scores, 0) / n).astype(np.float32)
        d_joined = d_scores @ w["out"].T
        d_states = np.stack([d_joined[..., :h].transpose(1, 0, 2), d_joined[:, ::-1, h:].transpose(1, 0, 2)], axis=1)
        d_symbol, d_recur = np.zeros_like(w["symbol"]), np.zeros_like(w["recur"])
        d_state, d_cell = np.zeros((2, n, h), np.float32), np.zeros((2, n, h), np.float32)
        for t in range(length - 1, -1, -1):
            g, on = gates[t], alive[:, :, t, None]
            tanh = np.tanh(cells[t + 1])
            ds = (d_state + d_states[t]) * on
            dc = (d_cell + ds * g[..., 2 * h : 3 * h] * (1 - tanh * tanh)) * on
            dg = np.concatenate([dc * g[..., 3 * h :], dc * cells[t], ds * tanh, dc * g[..., :h]], axis=-1)
            dg[..., : 3 * h] *= g[..., : 3 * h] * (1 - g[..., : 3 * h])
            dg[..., 3 * h :] *= 1 - g[..., 3 * h :] ** 2
            for k in (0, 1):
                np.add.at(d_symbol[k], both[k, :, t], dg[k])
            d_recur += states[t].transpose(0, 2, 1) @ dg
            d_state, d_cell = dg @ w["recur"].transpose(0, 2, 1), dc * g[..., h : 2 * h]
        flat = d_scores.reshape(-1, TAGS)
        return float((total - gold).mean()), {
            "symbol": d_symbol, "recur": d_recur, "out": joined.reshape(-1, 2 * h).T @ flat, "bias": flat.sum(0),
            "next": np.where(self.barred, 0, d_next / n).astype(np.float32),
        }

    def train(self, codes: np.ndarray, tags: np.ndarray, steps: int = 200, batch: int = 64, rate: float = 0.02, seed: int = 7) -> None:
        rng, m, s = np.random.default_rng(seed), {}, {}
        for t in range(1, steps + 1):
            pick = rng.integers(0, len(codes), batch)
            _, found = self.gradients(codes[pick], tags[pick].astype(np.int64))
            norm = max(1.0, float(np.sqrt(sum((g * g).sum() for g in found.values()))) / 5)
            for name, g in found.items():
                g = g / norm
                m[name] = 0.9 * m.get(name, 0) + 0.1 * g
                s[name] = 0.99 * s.get(name, 0) + 0.01 * g * g
                self.weights[name] -= (rate * (1 - 0.9 * t / steps) * (m[name] / (1 - 0.9**t)) / (np.sqrt(s[name] / (1 - 0.99**t)) + 1e-8)).astype(np.float32)

    def decode(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The best tags of each window, and at each place what its tag gains over outside."""
        scores, _ = self.emissions(codes)
        move, (n, length) = self._transitions(), codes.shape
        best = scores[:, 0] + np.where((np.arange(TAGS) % 2 == 0) & (np.arange(TAGS) > 0), np.float32(-1e4), np.float32(0))
        came = np.zeros((length, n, TAGS), np.int8)
        for t in range(1, length):
            steps = best[:, :, None] + move
            came[t] = steps.argmax(1)
            best = steps.max(1) + scores[:, t]
        tags, rows = np.zeros((n, length), np.int64), np.arange(n)
        tags[:, -1] = best.argmax(1)
        for t in range(length - 1, 0, -1):
            tags[:, t - 1] = came[t, rows, tags[:, t]]
        gain = np.take_along_axis(scores, tags[..., None], -1)[..., 0] - scores[..., 0]
        gain[:, 1:] += move[tags[:, :-1], tags[:, 1:]] - move[0, 0]
        return tags, gain


def decoded_spans(tags: np.ndarray, gain: np.ndarray, window: tuple[int, int, bool, bool]) -> list[tuple[int, int, int, float]]:
    """(start, end, kind, log-odds) of the spans in a window that do not touch a cut edge."""
    start, end, cut_left, cut_right = window
    out, at, n = [], 0, end - start
    while at < n:
        if tags[at] == 0:
            at += 1
            continue
        stop = at + 1
        while stop < n and tags[stop] == tags[at] + 1 and tags[at] % 2 == 1:
            stop += 1
        if not (cut_left and at == 0) and not (cut_right and stop == n):
            out.append((start + at, start + stop, (int(tags[at]) - 1) // 2, float(gain[at:stop].sum())))
        at = stop
    return out


def reconcile(found: list[tuple[int, int, int, float]], taken: list[Span]) -> list[Span]:
    """The non-overlapping spans of the highest total log-odds among those that are clear of ``taken``."""
    merged: list[list[int]] = []
    for a, b, _ in sorted(taken):
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    starts = [a for a, _ in merged]
    best: dict[Span, float] = {}
    for a, b, kind, odds in found:
        if odds >= LEAST_ODDS:
            best[a, b, kind] = max(odds, best.get((a, b, kind), 0))
    free = []
    for (a, b, kind), odds in best.items():
        k = bisect_left(starts, b)  # the taken stretches before this one begin in time; only the last can reach in
        if not k or merged[k - 1][1] <= a:
            free.append((a, b, kind, odds))
    free.sort(key=lambda s: (s[1], s[0], s[2]))
    ends = [s[1] for s in free]
    total, choice = [0.0], []
    for i, (a, _, _, odds) in enumerate(free):
        before = int(np.searchsorted(ends[:i], a, "right"))
        choice.append(before if total[before] + odds > total[i] else -1)
        total.append(max(total[i], total[before] + odds))
    out, i = [], len(free)
    while i:
        if choice[i - 1] < 0:
            i -= 1
        else:
            out.append(free[i - 1][:3])
            i = choice[i - 1]
    return out


def tag_texts(texts: list[str], taken: list[list[Span]], tagger: Tagger, batch: int = 256) -> list[list[Span]]:
    """The tagger's further spans of each text; windows of all texts are decoded in batches."""
    all_codes = [codes_of(t) if _trigger.search(t) else np.zeros(0, np.int64) for t in texts]
    places = [(i, w) for i, c in enumerate(all_codes) for w in windows_of(c)]
    found: list[list[tuple[int, int, int, float]]] = [[] for _ in texts]
    for a in range(0, len(places), batch):
        part = places[a : a + batch]
        codes = np.zeros((len(part), WINDOW), np.int64)
        for k, (i, (start, end, *_)) in enumerate(part):
            codes[k, : end - start] = all_codes[i][start:end]
        for (i, window), tags, gain in zip(part, *tagger.decode(codes)):
            found[i] += decoded_spans(tags, gain, window)
    return [reconcile(f, t) if f else [] for f, t in zip(found, taken)]


def _texts(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Rows (id, text) in groups of bounded text."""
    for part in parts:
        begin, held, texts = 0, 0, []
        for i, value in enumerate(part.column(1)):
            texts.append(value.as_py() or "")
            held += len(texts[-1])
            if held > _SLICE or i + 1 == part.num_rows:
                yield part.slice(begin, i + 1 - begin), texts
                begin, held, texts = i + 1, 0, []


def train_tagger(docs: DataFrame) -> Tagger | None:
    """A tagger trained on a bounded sample of ``docs`` (id, text); None where the sample has no span."""
    some = docs.select(F.col("id").alias("_some")).orderBy(F.xxhash64("_some")).limit(TRAINING_DOCUMENTS).distinct()
    picked = docs.join(F.broadcast(some), F.col("id").eqNullSafe(F.col("_some")), "left_semi")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in _texts(parts):
            sorts, found = [], []
            for text in texts:
                if _trigger.search(text):
                    for sort, window in training_windows(text):
                        sorts.append(sort)
                        found.append(window)
            yield pa.RecordBatch.from_arrays([pa.array(sorts, pa.int32()), pa.array(found, pa.binary())], ["sort", "window"])

    windows = picked.mapInArrow(run, "sort int, window binary")
    got = [
        row.window
        for sort in range(3)
        for row in windows.where(F.col("sort") == sort).select("window").distinct().orderBy(F.xxhash64("window"), "window").limit(TRAINING_WINDOWS).collect()
    ]
    whole = np.frombuffer(b"".join(got), np.int8).reshape(-1, 2, WINDOW).astype(np.int64)
    if not (whole[:, 1] > 0).any():
        return None
    # an inside tag at the start of a cut window has no begin before it; leave such windows out
    whole = whole[(whole[:, 1, 0] == 0) | (whole[:, 1, 0] % 2 == 1)]
    tagger = Tagger()
    if len(whole):
        tagger.train(whole[:, 0], whole[:, 1])
    return tagger


def training_windows(text: str) -> Iterator[tuple[int, bytes]]:
    """(sort, symbols and tags) of a text's windows: 0 with rewritten spans, 1 with spans as they were, 2 without any."""
    spans = base_spans(text)[0]
    for sort, (version, known) in enumerate((rewritten(text, spans), (text, spans))):
        codes = codes_of(version)
        for start, end, *_ in windows_of(codes) if spans or sort else ():
            near = [s for s in known if s[0] < end and s[1] > start]
            window = np.zeros(WINDOW, np.int8)
            window[: end - start] = codes[start:end]
            yield (sort if near else 2), np.concatenate([window, tags_of(near, start, end)]).tobytes()


def line_of(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], s[2])))


FOUND = {**{f"n_{k}": "bigint" for k in KINDS}, "base_sha256": "string", "spans": "string", "n_added": "bigint"}


def find(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added): one row for each row of ``docs``.

    The counts and the digest are of base spans; ``spans`` has the tagger's as well.
    """
    narrow = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text).alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(train_tagger(narrow))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = sent.value
        for rows, texts in _texts(parts):
            base = [base_spans(t) for t in texts]
            added = tag_texts(texts, [kept + refused for kept, refused in base], tagger) if tagger else [[] for _ in texts]
            counts = [pa.array([sum(s[2] == k for s in kept) for kept, _ in base], pa.int64()) for k in range(len(KINDS))]
            digest = [hashlib.sha256(line_of(kept).encode()).hexdigest() for kept, _ in base]
            spans = [line_of(kept + more) for (kept, _), more in zip(base, added)]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), *counts, pa.array(digest, pa.string()), pa.array(spans, pa.string()), pa.array([len(x) for x in added], pa.int64())],
                ["id", *FOUND],
            )

    return narrow.mapInArrow(run, "id bigint, " + ", ".join(f"{k} {t}" for k, t in FOUND.items()))
