"""Edit-aware token counts: a segment tree of pre-token runs for each document.

``with_trees`` cuts each text into leaves of about ``LEAF`` code points, only at places where the tokenizer's pre-tokens are
bound to end (before white space that follows something else), so a text's tokens are those of its leaves. The row
keeps the leaves' lengths and a segment tree of their token counts.

``recount`` applies edits (start, stop, replacement in code points of the old text) from right to left. It encodes again only
the leaves an edit touches, and as many neighbours as it takes until both borders are safe again; changed sums
go up the tree, untouched leaves are not encoded.

Defined results: NULL texts count as empty, NULL edits as none. Edits are sorted; bounds outside the text are moved to its
ends; an edit that starts before the end of the one before it is skipped (``n_skipped``). Edits with a NULL start, stop or
replacement are skipped too. Repeated rows are counted on their own. A stretch without white space is one leaf, however long.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.llm.tokenizers import BYTE_BPE, byte_bpe

LEAF = 512
EDITS = "array<struct<start:bigint,stop:bigint,replacement:string>>"
_SAFE = re.compile(r"(?<=\S)(?=\s)")
_HELD = 4 << 20

Encode = Callable[[str], list[int]]


def leaves(text: str, leaf: int = LEAF) -> list[str]:
    """The text in pieces of at least ``leaf`` code points that end at safe places (the last may be shorter)."""
    out, at = [], 0
    while at < len(text):
        cut = _SAFE.search(text, at + leaf)
        end = cut.start() if cut else len(text)
        out.append(text[at:end])
        at = end
    return out


def tree_of(counts: list[int]) -> list[int]:
    """Node k has the sum of nodes 2k and 2k + 1; leaves start at half the length; node 1 is the total."""
    n = 1
    while n < len(counts):
        n *= 2
    tree = [0] * n + counts + [0] * (n - len(counts))
    for k in range(n - 1, 0, -1):
        tree[k] = tree[2 * k] + tree[2 * k + 1]
    return tree


def set_leaf(tree: list[int], leaf: int, count: int) -> None:
    k = len(tree) // 2 + leaf
    change = count - tree[k]
    while k:
        tree[k] += change
        k //= 2


def apply_edits(text: str, lengths: list[int], tree: list[int], edits: list[tuple[int, int, str]], encode: Encode) -> tuple[str, list[int], int, int, int]:
    """The new text and slot lengths, the edits applied and skipped, and the code points encoded again; ``tree`` is brought up to date."""
    slots, starts, at = [], [], 0
    for n in lengths or [0]:
        slots.append(text[at : at + n])
        starts.append(at)
        at += n
    applied, skipped, end = [], 0, 0
    clipped = ((max(0, min(a, at)), max(0, min(b, at)), new) for a, b, new in edits if None not in (a, b, new))
    for a, b, new in sorted((a, max(a, b), new) for a, b, new in clipped):
        if a < end:
            skipped += 1
        else:
            applied.append((a, b, new))
            end = max(b, end)
    skipped += sum(None in e for e in edits)
    encoded, live = 0, list(range(len(slots)))  # slots that still hold text of their own, in order
    for a, b, new in reversed(applied):
        first = max(i for i, s in enumerate(live) if starts[s] <= a)
        last = max(i for i, s in enumerate(live) if starts[s] <= max(a, b - 1))
        whole = "".join(slots[s] for s in live[first : last + 1])
        # all that was edited lies to the right, so old places hold up to the stop
        whole = whole[: a - starts[live[first]]] + new + whole[b - starts[live[first]] :]
        while first > 0 and not (whole and whole[0].isspace()):
            first -= 1
            whole = slots[live[first]] + whole
        while last + 1 < len(live) and (not whole or whole[-1].isspace()):
            last += 1
            whole += slots[live[last]]
        keep = live[first]
        for s in live[first + 1 : last + 1]:
            slots[s] = ""
            set_leaf(tree, s, 0)
        slots[keep] = whole
        set_leaf(tree, keep, len(encode(whole)))
        encoded += len(whole)
        del live[first + 1 : last + 1]
    return "".join(slots), [len(s) for s in slots], len(applied), skipped, encoded


def with_trees(docs: DataFrame, path: str = BYTE_BPE, text: str = "text") -> DataFrame:
    """``docs`` with ``leaf_chars`` and ``token_tree``; node 1 of the tree is the token count."""
    columns = [c for c in docs.columns if c not in ("leaf_chars", "token_tree")]
    kept = docs.select(*columns)
    schema = kept.withColumns({"leaf_chars": F.lit(None).cast("array<bigint>"), "token_tree": F.lit(None).cast("array<bigint>")}).schema
    at = columns.index(text)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_bpe(path).encode_ordinary
        for part in parts:
            begin, held, lengths, trees = 0, 0, [], []
            for i, value in enumerate(part.column(at)):
                pieces = leaves(value.as_py() or "")
                lengths.append([len(p) for p in pieces])
                trees.append(tree_of([len(encode(p)) for p in pieces]))
                held += sum(lengths[-1])
                if held > _HELD or i + 1 == part.num_rows:
                    rows = part.slice(begin, i + 1 - begin)
                    added = [pa.array(x, pa.list_(pa.int64())) for x in (lengths, trees)]
                    yield pa.RecordBatch.from_arrays([*rows.columns, *added], [*columns, "leaf_chars", "token_tree"])
                    begin, held, lengths, trees = i + 1, 0, [], []

    return kept.mapInArrow(run, schema)


COUNTED = {"n_tokens": "bigint", "n_edits": "bigint", "n_skipped": "bigint", "n_tokens_after": "bigint", "n_chars_after": "bigint", "chars_encoded": "bigint", "edited": "string"}


def recount(trees: DataFrame, edits: str = "edits", path: str = BYTE_BPE, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, COUNTED..., leaf_chars, token_tree): counts before and after the edits of each row, the edited text and its tree.

    ``leaf_chars`` and ``token_tree`` of a row with edits have empty slots where leaves were joined; they can be edited again.
    """
    schema = ", ".join(["id bigint", *(f"{k} {t}" for k, t in COUNTED.items()), "leaf_chars array<bigint>", "token_tree array<bigint>"])
    names = ["id", *COUNTED, "leaf_chars", "token_tree"]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_bpe(path).encode_ordinary
        for part in parts:
            out, held = [], 0
            for number, value, lengths, tree, wanted in zip(*part.columns):
                old, tree, lengths = value.as_py() or "", tree.as_py(), lengths.as_py()
                before = tree[1]
                asked = [(e["start"], e["stop"], e["replacement"]) if e else (None, None, None) for e in wanted.as_py() or []]
                new, done, skipped, encoded = old, 0, 0, 0
                if asked:
                    new, lengths, done, skipped, encoded = apply_edits(old, lengths, tree, asked, encode)
                out.append((number.as_py(), before, done, skipped, tree[1], len(new), encoded, new, lengths, tree))
                held += len(new)
                if held > _HELD:
                    yield _batch(out, names)
                    out, held = [], 0
            yield _batch(out, names)

    picked = trees.select(F.col(id_column).cast("bigint"), text, "leaf_chars", "token_tree", F.col(edits).cast(EDITS))
    return picked.mapInArrow(run, schema)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    types = [*[pa.int64()] * 7, pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    columns = zip(*rows) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def every_match_edits(text: str = "text", pattern: str = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+|[0-9]{4,}", mask: str = "[private]") -> Column:
    """Edits that put ``mask`` over every match of ``pattern``, each at its own place."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("replacement", pa.string())]))

    @F.arrow_udf(EDITS)
    def edits(texts: pa.Array) -> pa.Array:
        find = re.compile(pattern).finditer
        return pa.array([[{"start": m.start(), "stop": m.end(), "replacement": mask} for m in find(t.as_py() or "")] for t in texts], kind)

    return edits(F.col(text))


def masking_edits(text: str = "text", pattern: str = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+|[0-9]{4,}", mask: str = "[private]") -> Column:
    """Edits that put ``mask`` over the first place of each different match of ``pattern``."""
    found = F.array_distinct(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({pattern})"), F.lit(1)))
    place = lambda m: F.instr(F.col(text), m).cast("bigint") - 1
    return F.transform(found, lambda m: F.struct(place(m).alias("start"), (place(m) + F.length(m)).alias("stop"), F.lit(mask).alias("replacement"))).cast(EDITS)
